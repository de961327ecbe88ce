"""Newick text to node rows and back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tokens(text: str) -> Iterator[str]:
    """Punctuation, quoted labels and bare words; comments in square brackets are left out."""
    i, n = 0, len(text)
    while i < n:
        ch = text[i]
        if ch in "(),:;":
            yield ch
            i += 1
        elif ch == "[":
            i = text.index("]", i) + 1
        elif ch == "'":
            out, i = [], i + 1
            while True:
                j = text.index("'", i)
                out.append(text[i:j])
                if text[j + 1 : j + 2] != "'":
                    break
                out.append("'")
                i = j + 2
            yield "'" + "".join(out)
            i = j + 1
        elif ch.isspace():
            i += 1
        else:
            j = i
            while j < n and text[j] not in "(),:;[" and not text[j].isspace():
                j += 1
            yield text[i:j]
            i = j


def parse(text: str) -> list[tuple[str, str | None, float | None]]:
    """(node, parent, length) rows; unnamed inner nodes become ``inner1``, ``inner2``, ... in the order they open."""
    made, stack, rows, node, after_colon = 0, [], [], None, False
    for t in tokens(text):
        if t == "(":
            made += 1
            new = [f"inner{made}", stack[-1] if stack else None, None]
            rows.append(new)
            stack.append(new)
            node, after_colon = None, False
        elif t in ",)":
            if node is None and not after_colon:
                raise ValueError("a label is missing")
            if t == ")":
                if not stack:
                    raise ValueError("unbalanced brackets")
                node = stack.pop()
            else:
                node = None
            after_colon = False
        elif t == ":":
            after_colon = True
        elif t == ";":
            break
        elif after_colon:
            node[2] = float(t)
        elif node is not None and node in rows and t:
            node[0] = t.removeprefix("'")
        else:
            node = [t.removeprefix("'"), stack[-1] if stack else None, None]
            rows.append(node)
    if stack:
        raise ValueError("unbalanced brackets")
    names = [r[0] for r in rows]
    if len(set(names)) != len(names):
        raise ValueError("repeated labels")
    return [(name, parent[0] if parent else None, length) for name, parent, length in rows]


def written(rows: list[tuple[str, str | None, float | None]], digits: int = 12) -> str:
    """Newick text; children in the order of the rows, labels quoted where they need it."""
    kids: dict[str | None, list[tuple[str, float | None]]] = {}
    for node, parent, length in rows:
        kids.setdefault(None if pd.isna(parent) else parent, []).append((node, length))
    label = lambda s: s if s and not set(s) & set("(),:;[]' ") else "'" + s.replace("'", "''") + "'"
    out: list[str] = []
    stack: list[tuple] = [("node", *kids[None][0])]
    while stack:
        kind, *rest = stack.pop()
        if kind == "text":
            out.append(rest[0])
            continue
        node, length = rest
        end = label(node) + (f":{length:.{digits}g}" if length is not None and not pd.isna(length) else "")
        below = kids.get(node, [])
        if not below:
            out.append(end)
            continue
        out.append("(")
        stack.append(("text", ")" + end))
        for i, (n, x) in reversed(list(enumerate(below))):
            stack.append(("node", n, x))
            if i:
                stack.append(("text", ","))
    return "".join(out) + ";"


def read_trees(texts: DataFrame) -> DataFrame:
    """(tree, node, parent, length, error) of (tree, newick) rows; a broken text gives one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, text in batch.itertuples(index=False, name=None):
                try:
                    out += [(tree, *row, None) for row in parse(text or "")]
                except (ValueError, TypeError) as e:
                    out.append((tree, None, None, None, str(e)))
            yield pd.DataFrame(out, columns=["tree", "node", "parent", "length", "error"])

    return texts.select("tree", "newick").mapInPandas(run, f"tree {dict(texts.dtypes)['tree']}, node string, parent string, length double, error string")


def write_trees(nodes: DataFrame) -> DataFrame:
    """(tree, newick) of node tables; siblings in order of name."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        return pd.DataFrame([(rows["tree"].iloc[0], written(list(rows[["node", "parent", "length"]].itertuples(index=False, name=None))))], columns=["tree", "newick"])

    return nodes.select("tree", "node", "parent", F.col("length").cast("double").alias("length")).groupBy("tree").applyInPandas(run, f"tree {dict(nodes.dtypes)['tree']}, newick string")


def renamed(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Node tables whose nodes with a sample bear its ``export_id``, as their children's parents too; ``ids`` are (sample_id, export_id)."""
    named = nodes.join(ids, "sample_id", "left").select("*", F.coalesce("export_id", "node").alias("_name"))
    above = named.select(F.col("node").alias("parent"), F.col("_name").alias("_above"))
    return named.join(above, "parent", "left").select(F.col("_name").alias("node"), F.col("_above").alias("parent"), "length", "sample_id")
