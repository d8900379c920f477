"""Transform templates: SQL text in which ``{0}`` stands for the mapped column."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame

_PLACEHOLDER = "{0}"


def expand(template: str, column: str) -> str:
    """Put a column name into a template; other braces are left alone."""
    return template.replace(_PLACEHOLDER, column)


def is_repeatable(df: DataFrame) -> bool:
    """Whether a second evaluation of the frame surely gives the same rows, as its analysed plan tells.

    Every expression must be deterministic, also in subqueries, and none may read the clock, which each evaluation
    reads anew. Encryption that draws its own nonce counts as random, and so does any function that is not Spark's
    own, as nothing tells what it does. The plan's nodes are looked at, not a text of it.
    """
    plan = df._jdf.queryExecution().analyzed()
    clock = df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.CURRENT_LIKE()
    if not plan.deterministic() or plan.containsPattern(clock):
        return False
    return not _any_unrepeatable(json.loads(plan.toJSON()))


def _any_unrepeatable(value: Any) -> bool:
    """Trees are lists of their nodes, each before its children; nodes hold other trees as fields."""
    if isinstance(value, dict):
        return any(_any_unrepeatable(field) for field in value.values())
    if not isinstance(value, list):
        return False
    return any(_is_unrepeatable(value, place) or _any_unrepeatable(node) for place, node in enumerate(value))


def _is_unrepeatable(nodes: list, place: int) -> bool:
    node = nodes[place]
    kind = node.get("class", "").rpartition(".")[2] if isinstance(node, dict) else ""
    if kind == "AesEncrypt":
        children = _children(nodes, place)
        mode, nonce = children[node["mode"]], children[node["iv"]]
        return _literal(mode, "").upper() != "ECB" and _literal(nonce, None) == ""
    return "UDF" in kind or kind in ("ApplyFunctionExpression", "ScalaAggregator", "V2Aggregator")


def _children(nodes: list, place: int) -> list[list]:
    """The subtrees below a node."""
    found, at = [], place + 1
    for _ in range(nodes[place]["num-children"]):
        end = _end(nodes, at)
        found.append(nodes[at:end])
        at = end
    return found


def _end(nodes: list, place: int) -> int:
    at = place + 1
    for _ in range(nodes[place]["num-children"]):
        at = _end(nodes, at)
    return at


def _literal(tree: list, otherwise: str | None) -> str | None:
    """The text of a literal, or of one that is cast."""
    while tree and tree[0].get("class", "").endswith(".Cast"):
        tree = tree[1:]
    if tree and tree[0].get("class", "").endswith(".Literal"):
        return tree[0].get("value")
    return otherwise
