"""The dealt operators as queries over the whole of the given tables, with DuckDB equivalents where SQL has them."""

from __future__ import annotations

import importlib.util
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.llm import copies, exact_dedup, fingerprints, language, mixing, near_dedup, packing, phrases, repeats, spelling, tokens, toxicity, warc
from specflow.llm.registry import query, table

#: The folder of the public tokenizers' vocabularies.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER, folder: str | None = None) -> str:
    """Where the public vocabulary file is, as the package beside the files says."""
    folder = folder or TOKENIZERS
    spec = importlib.util.spec_from_file_location("public_tokenizers", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    sys.modules.setdefault("public_tokenizers", module)
    spec.loader.exec_module(module)
    return module.path(name)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op3_near_dedup")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents")).drop("text")


@query("op5_warc")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    return derived.drop("record")


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query("op7_tokens")
def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@query(
    "op8_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
    ), g AS (
        SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS r
        FROM n
    )
    SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(t) AS text_sha256 FROM g
    """,
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query(
    "op10_repeats",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, row_number() OVER () AS r FROM documents
    ), s AS (
        SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35
    ), x AS (
        SELECT r, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM s
    ), gone AS (
        SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM x WHERE n > 1
    ), kept AS (
        SELECT r, count(*) AS n, string_agg(v, ' ' ORDER BY i) AS t
        FROM (SELECT r, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_spelling")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op12_copies")
def op12_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda sum_, span: sum_ + span["end"] - span["begin"])
    n_spans = F.size("removed").cast("long")
    cut = copies.cut_texts(docs).select(
        "k1", "k2", "first_id", "n", "n_bytes", n_removed.alias("n_removed"), n_spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    return copies.of_documents(docs, cut).drop("whole")


@query(
    "op13_phrases",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents
    ), w AS (
        SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces
    ), s AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w
    ), g AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
    ), n AS (
        SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang
    ), c AS (
        SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 30
    ), cuts AS (
        SELECT c.*, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
        FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k
    ), scored AS (
        SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score,
               row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY 2000000::HUGEINT * a // (x.f + y.f), j) AS nth
        FROM cuts JOIN g x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN g y ON y.lang = cuts.lang AND y.phrase = cuts.y
    ), inside AS (
        SELECT lang, array_to_string(w[b:b + m - 1], ' ') AS phrase, max(a) AS longer
        FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS b) WHERE m < k AND b + m - 1 <= k GROUP BY ALL
    ), kept AS (
        SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase)
        WHERE nth = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
    ), ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
    """,
)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
