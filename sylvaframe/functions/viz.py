"""Trees as text: drawn with lines, as a DOT graph, or two side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import map_rows
from .tree import bind, pre_order


def draw(nodes: list, show_features: bool = False) -> str:
    """One line a node; ``nodes`` are mappings as in a NODE array."""
    if nodes is None or not len(nodes):
        return "<empty tree>"
    below: dict[int, list] = {}
    for n in nodes:
        below.setdefault(n["head"], []).append(n)
    roots = below.get(0, [])
    if not roots:
        return "<empty tree>"
    lines, stack = [], [(roots[-1], "", True)]
    while stack:
        n, indent, last = stack.pop()
        line = f"{n['word']} ({n['pos']})" + (f" --{n['rel']}-->" if n["head"] else "")
        morph = n["morph"]
        pairs = sorted(dict(morph).items()) if morph is not None else []
        if show_features and pairs:
            line += f" [{', '.join(map(': '.join, pairs))}]"
        lines.append(indent + ("└── " if last else "├── ") + line)
        kids = below.get(n["idx"], [])
        deeper = indent + ("    " if last else "│   ")
        stack.extend((kid, deeper, i == 0) for i, kid in enumerate(reversed(kids)))
    return "\n".join(lines)


def with_tree_text(df: DataFrame, nodes: str, out: str, show_features: bool = False) -> DataFrame:
    """``df`` with a drawing of the tree in column ``nodes``."""
    return map_rows(df, out, "string", lambda: lambda t: draw(t, show_features), nodes)


def tree_dot(nodes: Column, show_features: bool = False) -> Column:
    """DOT text: a line for each node, followed by the edges to its children, in pre-order."""
    quote = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.coalesce(c, F.lit("")), r'(["\\])', r"\\$1"), F.lit('"'))

    def body(order: Column) -> Column:
        def one(i: Column) -> Column:
            n = F.element_at(F.filter(nodes, lambda m: m["idx"] == i), 1)
            label = F.concat(n["word"], F.lit("\\n"), n["pos"])
            if show_features:
                shown = F.array_join(F.transform(F.array_sort(F.map_entries(n["morph"])), lambda e: F.concat(F.lit("\\n"), e["key"], F.lit(": "), e["value"])), "")
                label = F.concat(label, F.coalesce(shown, F.lit("")))
            # the line break is an escape of DOT's own, so it is put in after quoting
            head = F.concat(F.lit("\t"), i.cast("string"), F.lit(" [label="), F.replace(quote(label), F.lit("\\\\n"), F.lit("\\n")), F.lit("]"))
            kids = F.filter(nodes, lambda m: m["head"] == i)
            lines = F.transform(kids, lambda k: F.concat(F.lit("\t"), i.cast("string"), F.lit(" -> "), k["idx"].cast("string"), F.lit(" [label="), quote(k["rel"]), F.lit("]")))
            return F.concat(F.array(head), lines)

        return F.array_join(F.flatten(F.transform(order, one)), "\n")

    return F.concat(F.lit("digraph {\n\trankdir=TB\n"), F.coalesce(bind(pre_order(nodes), body), F.lit("")), F.lit("\n}"))


def side_by_side(left: str, right: str, label: str | None = None, gap: int = 4) -> str:
    a, b = left.split("\n"), right.split("\n")
    width = max(map(len, a)) + gap
    rows = ["Premise:".ljust(width) + "Hypothesis:", "-" * (width + max(map(len, b)))]
    for i in range(max(len(a), len(b))):
        rows.append((a[i] if i < len(a) else "").ljust(width) + (b[i] if i < len(b) else ""))
    if label:
        rows.append(f"\nRelationship: {label}")
    return "\n".join(rows)


def with_pair_text(df: DataFrame, left: str, right: str, label: str, out: str) -> DataFrame:
    """``df`` with the trees of two columns drawn next to each other."""
    return map_rows(df, out, "string", lambda: lambda a, b, c: side_by_side(draw(a), draw(b), c), left, right, label)
