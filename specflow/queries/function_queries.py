"""Every documented function, used in a transform template over a whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specflow.plans.spec import SinkColumn
from specflow.queries.common import QUERIES, ORACLES, given, lazy

_KEYS = {
    "customer": "c_custkey",
    "documents": "doc_id",
    "lineitem": "l_orderkey",
    "orders": "o_orderkey",
    "part": "p_partkey",
}


def _function(name: str, table: str, column: str, template: str, sql: str, kind: str = "String") -> None:
    """Register ``fn_<name>``: the table's key and the template applied to one column."""
    key = _KEYS[table]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        targets = [
            (key, SinkColumn("id", "Long")),
            (column, SinkColumn("result", kind, transform=template)),
        ]
        return lazy(spark, given(table, sf_dir), targets)

    run.__name__ = f"fn_{name}"
    QUERIES[f"fn_{name}"] = run
    ORACLES[f"fn_{name}"] = f"SELECT {key} AS id, {sql} AS result FROM {table}"


# Text
_function("concat", "customer", "c_name", "concat({0} ,'_', '{to_be}')", "c_name || '_{to_be}'")
_function(
    "concat_ws",
    "customer",
    "c_mktsegment",
    "concat_ws('-', {0}, cast(null as string), 'end')",
    "concat_ws('-', c_mktsegment, NULL, 'end')",
)
_function("encode", "documents", "text", "hex(encode({0} ,'UTF-8'))", "hex(encode(text))")
_function("format_number", "orders", "o_totalprice", "format_number({0}, 2)", "format('{:,.2f}', o_totalprice)")
_function("length", "documents", "text", "length({0} )", "length(text)::INTEGER", "Int")
_function("lower", "documents", "text", "lower({0} )", "lower(text)")
_function("lpad", "customer", "c_mktsegment", "lpad({0} ,9,'#')", "lpad(c_mktsegment, 9, '#')")
_function("repeat", "customer", "c_mktsegment", "repeat({0} ,3)", "repeat(c_mktsegment, 3)")
_function("replace", "documents", "text", "replace({0}, 'e', '<3>')", "replace(text, 'e', '<3>')")
_function("reverse", "customer", "c_name", "reverse({0})", "reverse(c_name)")
_function("substr", "customer", "c_name", "substr({0},-6,4)", "substr(c_name, -6, 4)")
_function("substring", "documents", "text", "substring({0},2,40)", "substring(text, 2, 40)")
_function("trim", "customer", "c_mktsegment", "trim(concat('  ', {0}, ' '))", "c_mktsegment")
_function("upper", "part", "p_name", "upper({0})", "upper(p_name)")
_function("ucase", "part", "p_type", "ucase({0})", "upper(p_type)")

# Conditions
_function(
    "nvl",
    "customer",
    "c_mktsegment",
    "nvl(nullif({0}, 'BUILDING'),'replacement_string')",
    "coalesce(nullif(c_mktsegment, 'BUILDING'), 'replacement_string')",
)
_function(
    "coalesce",
    "customer",
    "c_mktsegment",
    "COALESCE(nullif({0}, 'MACHINERY'),CAST('replacement_string' as string))",
    "coalesce(nullif(c_mktsegment, 'MACHINERY'), 'replacement_string')",
)


# Masking
def _masked(text: str, upper: str = "X", lower: str = "x", number: str = "n") -> str:
    for pattern, letter in (("[A-Z]", upper), ("[a-z]", lower), ("[0-9]", number)):
        text = f"regexp_replace({text}, '{pattern}', '{letter}', 'g')"
    return text


_function("mask", "customer", "c_name", "mask({0},'U','L','#')", _masked("c_name", "U", "L", "#"))
_function("mask_defaults", "part", "p_name", "mask({0})", _masked("p_name"))
_function(
    "mask_first_n",
    "customer",
    "c_name",
    "mask_first_n({0})",
    f"{_masked('left(c_name, 4)')} || substr(c_name, 5)",
)
_function(
    "mask_last_n",
    "customer",
    "c_name",
    "mask_last_n({0}, 6)",
    f"left(c_name, length(c_name) - 6) || {_masked('right(c_name, 6)')}",
)
_function(
    "mask_show_first_n",
    "customer",
    "c_name",
    "mask_show_first_n({0}, 3)",
    f"left(c_name, 3) || {_masked('substr(c_name, 4)')}",
)
_function(
    "mask_show_last_n",
    "customer",
    "c_name",
    "mask_show_last_n({0})",
    f"{_masked('left(c_name, length(c_name) - 4)')} || right(c_name, 4)",
)

# Encryption
_function(
    "aes_roundtrip",
    "documents",
    "text",
    "cast(aes_decrypt(unbase64(base64(aes_encrypt({0}, '1234567890123456'))), '1234567890123456') as string)",
    "text",
)
_function(
    "aes_roundtrip_repeatable",
    "customer",
    "c_name",
    "cast(aes_decrypt(aes_encrypt({0}, '1234567890123456', 'ECB'), '1234567890123456', 'ECB') as string)",
    "c_name",
)
# The cipher text, by its length: whole blocks, and a nonce and a tag around the text.
_function(
    "aes_encrypt_blocks",
    "customer",
    "c_name",
    "octet_length(aes_encrypt({0}, '1234567890123456', 'ECB')) + if(aes_encrypt({0}, '1234567890123456', 'ECB') <> cast({0} as binary), 0, 1)",
    "(16 * (strlen(c_name) // 16 + 1))::INTEGER",
    "Int",
)
_function(
    "aes_encrypt_nonce",
    "documents",
    "text",
    "octet_length(aes_encrypt({0}, '1234567890123456'))",
    "(strlen(text) + 28)::INTEGER",
    "Int",
)

# Dates
_function(
    "from_unixtime",
    "orders",
    "o_orderkey",
    "from_unixtime({0} * 9973 ,'yyyy/MM/dd HH:mm:ss')",
    "strftime(make_timestamp(o_orderkey * 9973 * 1000000), '%Y/%m/%d %H:%M:%S')",
)
_function("unix_timestamp", "orders", "o_orderdate", "unix_timestamp({0})", "epoch(o_orderdate)::BIGINT", "Long")
_function(
    "unix_timestamp_text",
    "lineitem",
    "l_shipdate",
    "unix_timestamp(cast({0} as string))",
    "epoch(l_shipdate)::BIGINT",
    "Long",
)
_function(
    "unix_timestamp_fmt",
    "orders",
    "o_orderdate",
    "unix_timestamp(date_format({0}, 'yyyy-dd-MM HH:mm:ss'), 'yyyy-dd-MM HH:mm:ss')",
    "epoch(o_orderdate)::BIGINT",
    "Long",
)
_function("to_date", "lineitem", "l_shipdate", "to_date({0})", "l_shipdate::DATE::VARCHAR")
_function(
    "date_reformat",
    "orders",
    "o_orderdate",
    "from_unixtime(unix_timestamp(date_format({0}, 'd-M-yyyy'), 'dd-MM-yyyy'),'yyyy/MM/dd')",
    "strftime(o_orderdate, '%Y/%m/%d')",
)
_function(
    "now_consistent",
    "orders",
    "o_orderkey",
    "to_date(current_timestamp()) = current_date() and unix_timestamp() = unix_timestamp(current_timestamp())",
    "true",
    "Boolean",
)

# Numbers
_function("round", "lineitem", "l_extendedprice", "round({0})", "round(l_extendedprice)", "Double")
_function(
    "round_d",
    "lineitem",
    "l_extendedprice",
    "round(cast({0} as decimal(18,2)) * cast(0.07 as decimal(4,2)), 2)",
    "round(l_extendedprice::DECIMAL(18, 2) * 0.07::DECIMAL(4, 2), 2)::DOUBLE",
    "Double",
)
_function("floor", "lineitem", "l_extendedprice", "floor({0})", "floor(l_extendedprice)::BIGINT", "Long")
_function("ceil", "lineitem", "l_extendedprice", "ceil({0})", "ceil(l_extendedprice)::BIGINT", "Long")
_function("ceiling", "lineitem", "l_discount", "ceiling({0})", "ceil(l_discount)::BIGINT", "Long")
