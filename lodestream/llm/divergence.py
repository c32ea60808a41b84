"""Source divergence audit over a K²-tree of the group-term count matrix.

The terms of a language are dealt into blocks of columns, its sources into blocks of rows. A cell holds the rows of one
or two row blocks over one column block as a quadtree with K = 2: a node is a quadrant that holds a count, a quadrant
without counts is not stored. Pairs of rows go down their trees together: where both quadrants are absent, every column
of them gives the same value, which is priced by counting columns; what is left are leaves, priced one by one. The
language's own counts are one more row of the matrix, and its leaves beside a group's are that group's terms.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import trimmed, written

#: Letters after lower-casing A-Z, and every byte of a character beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
GAP = re.compile(rb"[^a-z\x80-\xff]")


@dataclass(frozen=True)
class Audit:
    min_docs: int = 10
    smooth: int = 2
    scale: int = 1_000_000_000
    top: int = 10
    #: Groups of a language on each side of a cell, and terms of it: bounds of what one task holds at once.
    groups: int = 64
    terms: int = 4096
    #: Pairs of quadrants that a walk keeps at once.
    frontier: int = 1 << 18


def pieces_of(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes that no term crosses."""
    start = 0
    while len(text) - start > size:
        gap = GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:] if start else text


def term_counts(docs: DataFrame, held: int = 400_000) -> DataFrame:
    """(lang, source, term binary, count, docs): occurrences of each term in a group's texts and the documents that hold it.

    Tasks sum their own documents before anything is shuffled; ``held`` bounds the sums that one keeps.
    """

    def flushed(sums: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, within) in sums.items():
            terms = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array(counts.values(), pa.int64()), pa.array([within[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "count", "docs"],
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                counts, within = sums.setdefault((lang, source), (Counter(), Counter()))
                own: set[bytes] = set()
                for piece in pieces_of(value.as_py().lower()):
                    terms = TERM.findall(piece)
                    counts.update(terms)
                    own.update(terms)
                within.update(own)
            if sum(len(c) for c, _ in sums.values()) > held:
                yield from flushed(sums)
                sums.clear()
        yield from flushed(sums)

    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = texts.mapInArrow(trimmed(counted), "lang string, source string, term binary, count long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, a: Audit) -> Column:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)), exact in decimals."""
    over = F.lit(a.scale).cast("decimal(12,0)") * (count.cast("decimal(19,0)") + F.lit(a.smooth))
    under = total.cast("decimal(19,0)") + F.lit(a.smooth) * terms.cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", over, under)


def spread(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)² / (p + q)), exact below 2**31."""
    return (p - q) ** 2 // (p + q)


def quadtree(row: np.ndarray, column: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(children, order) of the tree over a matrix of side 2**depth whose nonzero places are (row, column), each once.

    children[k][i] are the four quadrants of node i at level k as numbers of nodes at level k + 1, -1 where one holds
    nothing; quadrant 2 * (lower half) + (right half). Nodes of the last level are the places, in ``order``.
    """
    code = np.zeros(len(row), dtype=np.int64)
    for bit in range(depth):
        code |= ((row >> bit) & 1) << (2 * bit + 1) | ((column >> bit) & 1) << (2 * bit)
    order = np.argsort(code, kind="stable")
    code, children = code[order], []
    nodes = np.unique(code >> (2 * depth))
    for level in range(depth):
        below = np.unique(code >> (2 * (depth - level - 1)))
        child = np.full((max(1, len(nodes)), 4), -1, dtype=np.int64)
        child[np.searchsorted(nodes, below >> 2), below & 3] = np.arange(len(below))
        children.append(child)
        nodes = below
    return children, order


def walk(
    children: list[np.ndarray], rows: int, columns: int, split: int, limit: int, leaves: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], None]
) -> np.ndarray:
    """(rows, rows) counts of the columns where both rows a < b hold nothing; ``leaves`` gets (a, b, leaf of a, leaf of b) for every other column.

    A leaf is -1 where its row holds nothing. Pairs on the same side of row ``split`` are left out if it is below ``rows``.
    """
    depth = len(children)
    grid = np.zeros((rows + 1, rows + 1), dtype=np.int64)

    def priced(ra: np.ndarray, rb: np.ndarray, width: np.ndarray, side: int) -> None:
        a, b = ra * side, rb * side
        a_end, b_end = np.minimum(a + side, rows), np.minimum(b + side, rows)
        for x, y, sign in ((a, b, 1), (a_end, b, -1), (a, b_end, -1), (a_end, b_end, 1)):
            np.add.at(grid, (x, y), sign * width)

    def down(level: int, na: np.ndarray, nb: np.ndarray, ra: np.ndarray, rb: np.ndarray, c: np.ndarray) -> None:
        if not len(na):
            return
        if level == depth:
            leaves(ra, rb, na, nb)
            return
        if len(na) > limit:
            for k in range(0, len(na), limit):
                down(level, *(x[k : k + limit] for x in (na, nb, ra, rb, c)))
            return
        side, child, found = 1 << (depth - level - 1), children[level], []
        for low_a, low_b, right in ((0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1)):
            x, y, z = 2 * ra + low_a, 2 * rb + low_b, 2 * c + right
            inside = (x <= y if side > 1 else x < y) & (y * side < rows) & (z * side < columns)
            if split < rows:
                inside &= (x * side < split) & ((y + 1) * side > split)
            ia = np.where(na[inside] >= 0, child[na[inside], 2 * low_a + right], -1)
            ib = np.where(nb[inside] >= 0, child[nb[inside], 2 * low_b + right], -1)
            x, y, z = x[inside], y[inside], z[inside]
            empty = (ia < 0) & (ib < 0)
            priced(x[empty], y[empty], np.minimum(side, columns - z[empty] * side), side)
            found.append([v[~empty] for v in (ia, ib, x, y, z)])
        down(level + 1, *(np.concatenate(v) for v in zip(*found, strict=True)))

    zero = np.zeros(1, dtype=np.int64)
    down(0, zero, zero, zero, zero, zero)
    return grid.cumsum(0).cumsum(1)[:rows, :rows]


CELL = "lang string, a long, b long, term binary, value long"


def cell_values(table: pa.Table, a: Audit) -> pa.Table:
    """The values of one cell: of pairs of groups (term null), and of each group's ``top`` terms (b is -1).

    Rows of ``table`` are counts' shares p by (number of the group, -1 for the language; term), and with a null term each
    group's share of a term that it lacks, with the number of the block's terms as ``width``. Sides differ in ``lo`` and ``hi`` if the cell pairs two row blocks.
    """
    lang, cross = table.column("lang")[0].as_py(), table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
    number, p = table.column("number").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks()
    base, width = np.asarray(pc.is_null(term)), pc.max(table.column("width")).as_py() or 0
    groups = np.unique(number[base & (number >= 0)])
    names = groups if cross else np.append(groups, -1)
    place = {int(g): i for i, g in enumerate(names)}
    # The language's own row holds every term.
    lack = np.ones(len(names), dtype=np.int64)
    for g, v in zip(number[base], p[base], strict=True):
        lack[place[int(g)]] = v
    row = np.array([place[int(g)] for g in number[~base]], dtype=np.int64)
    coded = term.filter(pa.array(~base)).dictionary_encode()
    words, column = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    # Terms of most groups come first: what is left of the matrix is empty in large quadrants.
    many = np.bincount(column, minlength=len(words))
    at = np.empty(len(words), dtype=np.int64)
    at[np.argsort(-many, kind="stable")] = np.arange(len(words))
    depth = max(1, int(max(len(names), len(words)) - 1).bit_length())
    children, order = quadtree(row, at[column], depth)
    own, word = p[~base][order], column[order]
    alphabetical = np.empty(len(words), dtype=np.int64)
    alphabetical[np.asarray(pc.sort_indices(words))] = np.arange(len(words))
    total = np.zeros((len(names), len(names)), dtype=np.int64)
    best: list[np.ndarray] = []

    def leaves(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        left, right = np.where(i >= 0, own[i], lack[x]), np.where(j >= 0, own[j], lack[y])
        value = spread(left, right)
        np.add.at(total, (x, y), value)
        if not cross:
            terms = (y == len(groups)) & (i >= 0) & (left > right)
            best.append(np.stack([x[terms], value[terms], word[i[terms]]]))

    split = int(np.searchsorted(groups, (int(groups[0]) // a.groups + 1) * a.groups)) if cross else len(names)
    empty = walk(children, len(names), len(words), split, a.frontier, leaves)
    # Terms of the block that no group of this cell holds are columns without a place in the tree.
    total += (empty + max(0, width - len(words))) * spread(lack[:, None], lack[None, :])
    x, y = np.nonzero(np.triu(np.ones((len(groups), len(groups)), dtype=bool), 1))
    if cross:
        apart = (x < split) & (y >= split)
        x, y = x[apart], y[apart]
    g, value, word_of = np.concatenate(best, axis=1) if best else np.zeros((3, 0), dtype=np.int64)
    ranked = np.lexsort([alphabetical[word_of], -value, g])
    g, value, word_of = g[ranked], value[ranked], word_of[ranked]
    begins = np.searchsorted(g, g)
    top = np.arange(len(g)) - begins < a.top
    n, m = len(x), int(top.sum())
    return pa.table(
        {
            "lang": pa.array([lang] * (n + m), pa.string()),
            "a": np.concatenate([groups[x], groups[g[top]]]),
            "b": np.concatenate([groups[y], np.full(m, -1)]),
            "term": pa.concat_arrays([pa.nulls(n, pa.binary()), words.take(pa.array(word_of[top]))]),
            "value": np.concatenate([total[x, y], value[top]]),
        }
    )


def audit(docs: DataFrame, a: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of a language differ, and by which terms.

    Part ``pair`` has each other source of the language with the summed spread of their shares over all kept terms; part
    ``term`` has the ``top`` terms that a group holds more than its language does. Kept are a language's terms in at least
    ``min_docs`` of its documents. Ranks go by value, descending, then item by its UTF-8 bytes.

    Null texts, languages and sources are empty ones, which are a language and a source like any other. Repeated rows count
    as often as they occur. A language without kept terms gives pairs of value 0; a language with one source gives no
    pairs; an empty table gives no rows. Columns other than text, lang and source are not read.
    """
    counts = written(term_counts(docs), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("docs")).filter(F.col("docs") >= a.min_docs).drop("docs")
    kept = written(kept, "divergence-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_n"), F.ceil(F.count("*") / F.lit(a.terms)).alias("blocks"))
    kept = kept.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    matrix = written(counts.select("lang", "source", "term", "count").join(kept, ["lang", "term"]), "divergence-matrix")

    by_lang = Window.partitionBy("lang")
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.select(
        "lang", "source", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("number"), F.ceil(F.count("*").over(by_lang) / F.lit(a.groups)).alias("sides")
    )
    totals = matrix.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = written(groups.withColumn("n", F.coalesce("n", F.lit(0).cast("long"))), "divergence-groups")

    columns = ["lang", "block", "number", "sides", "term", "p", "width"]
    none = F.lit(None).cast("long").alias("width")
    known = groups.filter("v is not null")
    held = matrix.select("lang", "source", "term", "count", "block").join(known.select("lang", "source", "number", "sides", "n", "v"), ["lang", "source"])
    held = held.withColumn("p", share(F.col("count"), F.col("n"), F.col("v"), a)).select(*columns[:-1], none)
    lacking = known.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lacking = lacking.join(kept.groupBy("lang", "block").agg(F.count("*").alias("width")), ["lang", "block"])
    lacking = lacking.select("lang", "block", "number", "sides", F.lit(None).cast("binary").alias("term"), share(F.lit(0), F.col("n"), F.col("v"), a).alias("p"), "width")
    side = F.floor(F.col("number") / F.lit(a.groups))
    all_sides = F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1))
    rows = held.unionByName(lacking).select("*", side.alias("own"), all_sides.alias("other")).withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    whole = kept.join(known.select("lang", "sides").distinct(), "lang").withColumn("p", share(F.col("lang_count"), F.col("lang_n"), F.col("v"), a))
    whole = whole.select("lang", "block", F.lit(-1).cast("long").alias("number"), "sides", "term", "p", none, all_sides.alias("lo")).withColumn("hi", F.col("lo"))
    cell = ["lang", "block", "lo", "hi", "number", "term", "p", "width"]
    cells = rows.select(cell).unionByName(whole.select(cell))

    def values(table: pa.Table) -> pa.Table:
        return cell_values(table, a)

    found = written(cells.groupBy("lang", "block", "lo", "hi").applyInArrow(values, CELL), "divergence-values")
    one = found.filter("term is null").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = one.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value").select("lang", "x.a", "x.b", "value")
    named = groups.select("lang", "source", F.col("number").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    pairs = named.join(other, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    terms = found.filter("term is not null").select("lang", "a", "term", "value").join(named, ["lang", "a"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= a.top))
    return ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


#: The same rows as :func:`audit` of ``documents`` with its production parameters, in DuckDB.
AUDIT_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), found AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), counts AS (
    SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept k USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN counts c USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 2)) // (l.n + 2 * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), parts AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
