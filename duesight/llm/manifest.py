"""Merkle manifest of a dataset: a tree of digests for every source, and one over the sources.

Nodes of a level are numbered within their tree. ``FANOUT`` consecutive nodes make one of the next
level, and all of this is done by a *slot pivot*: one aggregate with ``FANOUT`` conditional columns
spreads a parent's children over slots; the columns joined and hashed are the parent, and the
columns without a child's own slot are its siblings. A source with a third of all rows is many
parents, each of a few rows, so no group is larger than the fanout.

Numbers within a source come from one range sort by (source, doc_id): a row's place in its range,
less the place where its source begins there, plus what earlier ranges hold of the source. Only
range sizes, a row per range and source, are accumulated. Trees are joined with what lies above
them one parent at a time, after the children have been spread.

Leaf: every field is ``-`` if null, else its UTF-8 byte count, ``:`` and the value. Rows without
source make a source of their own that comes first; rows without doc_id come first in theirs. Rows
with equal doc_id follow each other by leaf; repeated rows are leaves of their own. A source of one
row has that leaf as subroot. An empty table has no rows and no root. Other columns take no part,
unless asked for; clashing names don't matter, as all columns used are picked first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents

# Fixed value: children of a node.
FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(F.concat(*parts))


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def numbered(rows: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """Add ``pos`` (from 0 within ``tree``, a column) and ``n`` (rows of the tree). The last key of
    the sort spreads rows that are equal in all others over ranges."""
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("tie")]
    placed = spread.orderBy(*by).drop("tie").withColumn("place", F.monotonically_increasing_id())
    placed = materialize(placed, label).withColumn("part", F.shiftright("place", _ROW_BITS))
    sizes = placed.groupBy("part", F.col(tree).alias("t")).agg(F.count(F.lit(1)).alias("held"), F.min("place").alias("first"))
    whole = Window.partitionBy("t")  # as many rows as ranges hold the tree
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("part").alias("start__part"),
        F.col("t").alias("start__tree"),
        "first",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
        F.sum("held").over(whole).alias("n"),
    )
    on = (F.col("part") == F.col("start__part")) & F.col(tree).eqNullSafe(F.col("start__tree"))
    out = placed.join(starts, on).withColumn("pos", F.col("place") - F.col("first") + F.col("before"))
    return out.select(*rows.columns, "pos", "n")


def _slots() -> list[Column]:
    return [F.col(f"slot{i}") for i in range(FANOUT)]


def spread(nodes: DataFrame) -> DataFrame:
    """Slot pivot of ``tree pos n digest item``: a row for each parent with its children in columns
    ``slot0``.. and its ``digest``. Trees of one node are left out: that node is their root."""
    slot = F.col("pos") % FANOUT
    children = [F.max(F.when(slot == i, F.struct("digest", "item"))).alias(f"slot{i}") for i in range(FANOUT)]
    parent = F.floor(F.col("pos") / FANOUT).cast("long")
    rows = nodes.filter("n > 1").groupBy("tree", parent.alias("pos"), "n").agg(*children)
    joined = F.concat(*[F.coalesce(s["digest"], F.lit("")) for s in _slots()])
    return rows.withColumn("digest", digest(joined))


def grow(leaves: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels of slot pivots above ``leaves(tree, pos, n, digest, item)``, and ``tree digest``
    of the roots. Every level is written once; the driver reads one number of it."""
    levels, roots, nodes = [], [], leaves
    while True:
        roots.append(nodes.filter("n = 1").select("tree", "digest"))
        level = materialize(spread(nodes), label)
        most = level.agg(F.max("n").alias("most")).first().most
        if most is None:
            break
        levels.append(level)
        nodes = level.select("tree", "pos", F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), "digest", F.lit(0).alias("item"))
    out = roots[0]
    for more in roots[1:]:
        out = out.union(more)
    return levels, out


def children(level: DataFrame) -> DataFrame:
    """A row for each child of spread parents: ``tree pos item digest`` and the siblings ``left`` and
    ``right`` of its own slot, with the parent's ``path`` behind them."""
    held = F.array(*[s["digest"] for s in _slots()])
    items = F.array(*_slots())
    rows = level.select("tree", "pos", "path", "subroot", held.alias("d"), F.posexplode(items).alias("own", "child"))
    rows = rows.filter("child is not null")
    left = F.array_join(F.slice("d", F.lit(1), F.col("own")), "")
    right = F.array_join(F.slice("d", F.col("own") + 2, F.lit(FANOUT)), "")
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    pos = F.col("pos") * FANOUT + F.col("own")
    return rows.select("tree", pos.alias("pos"), "child.item", "child.digest", F.concat(step, "path").alias("path"), "subroot")


def _nothing() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def paths(levels: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """Leaves of trees of several nodes with their ``path``: siblings by level, from the leaf up.
    ``above(above_tree, path, subroot)`` is what lies over each tree's root, and that root; without
    it nothing lies over them."""
    down = None
    for level in reversed(levels):
        # Level by level, trees whose root is here join those whose parents came from above.
        top = level.filter(F.col("n") <= FANOUT)
        if above is None:
            top = top.withColumns({"path": _nothing(), "subroot": F.lit("")})
        else:
            top = top.join(above, F.col("tree").eqNullSafe(F.col("above_tree"))).drop("above_tree")
        if down is not None:
            inner = level.filter(F.col("n") > FANOUT).alias("l")
            upper = down.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"), "path", "subroot")
            on = F.col("tree").eqNullSafe(F.col("up_tree")) & (F.col("l.pos") == F.col("up_pos"))
            top = top.unionByName(inner.join(upper, on).drop("up_tree", "up_pos"))
        down = children(top)
    return down


def proofs(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``doc_id leaf subroot root path tampered`` for every row of ``docs``: ``path`` lists
    the siblings ``left`` and ``right`` of every level from the leaf to the root; ``tampered`` is the
    leaf of the row with text ``changed`` (null where that is null)."""
    fields = [F.col(f"`{c}`") for c in FIELDS]
    other = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf([*fields[:-1], changed]))
    rows = docs.select(F.col("source").alias("tree"), "doc_id", leaf(fields).alias("digest"), other.alias("tampered"))
    placed = numbered(rows, "tree", ["doc_id", "digest"], "manifest-leaves")
    leaves = placed.select("tree", "pos", "n", "digest", F.struct("doc_id", "tampered").alias("item"))
    levels, subroots = grow(leaves, "manifest")
    subroots = materialize(subroots, "manifest-subroots")
    top = numbered(subroots.withColumn("all", F.lit(0)), "all", ["tree"], "manifest-sources")
    top = top.select(F.col("all").alias("tree"), "pos", "n", "digest", F.struct(F.col("tree").alias("source")).alias("item"))
    top_levels, root = grow(top, "manifest-top")
    root = root.select(F.col("digest").alias("root"))
    over = top.filter("n = 1").select("item", "digest", _nothing().alias("path"))
    if top_levels:
        over = over.unionByName(paths(top_levels).select("item", "digest", "path"))
    over = materialize(over.select(F.col("item.source").alias("above_tree"), "path", F.col("digest").alias("subroot")), "manifest-paths")
    columns = ["item", "digest", "path", "subroot"]
    out = leaves.filter("n = 1").join(over, F.col("tree").eqNullSafe(F.col("above_tree"))).select(*columns)
    if levels:
        out = out.unionByName(paths(levels, over).select(*columns))
    return out.select("item.doc_id", F.col("digest").alias("leaf"), "subroot", root.scalar().alias("root"), "path", "item.tampered")


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = proofs(docs, F.when(chosen, lowered(F.col("text"))))
    out = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_LEVELS = 6  # of the check SQL, a source of up to 16^6 rows


def _sql() -> str:
    def encoded(column: str) -> str:
        return f"coalesce(strlen(({column})::VARCHAR) || ':' || ({column})::VARCHAR, '-')"

    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
    head = " || ".join(encoded(c) for c in FIELDS[:-1])
    low = f"translate(text, '{_UPPER}', '{_LOWER}')"

    def tree(name: str, base: str) -> list[str]:
        """Levels ``name0``.. with each node's siblings, from ``base`` with ``g pos n d``."""
        parts, source = [], base
        for k in range(_LEVELS):
            run = "PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
            parts.append(f"""{name}{k} AS (SELECT g, pos, n, d,
              coalesce(string_agg(d, '') OVER ({run} 16 PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND 16 FOLLOWING), '') AS r FROM {source})""")
            parts.append(f"""{name}up{k} AS (SELECT g, pos // 16 AS pos, any_value((n + 15) // 16) AS n,
              CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
              FROM {name}{k} GROUP BY g, pos // 16)""")
            source = f"{name}up{k}"
        return parts

    def climb(name: str, group: str, at: str) -> tuple[str, str]:
        """Joins and siblings from a node up its tree."""
        joins = " ".join(f"JOIN {name}{k} {name}_{k} ON {name}_{k}.g IS NOT DISTINCT FROM {group} AND {name}_{k}.pos = {at} // {16**k}" for k in range(_LEVELS))
        proof = " || ".join(f"{name}_{k}.l || {name}_{k}.r" for k in range(_LEVELS))
        return joins, proof

    def fold(name: str, columns: list[str], source: str) -> list[str]:
        parts = []
        for k in range(_LEVELS):
            parts.append(f"""{source}_{name}{k} AS (SELECT f.* REPLACE (CASE WHEN t.n = 1 THEN f.f ELSE sha256(t.l || f.f || t.r) END AS f)
              FROM {source if k == 0 else f"{source}_{name}{k - 1}"} f
              JOIN {name}{k} t ON t.g IS NOT DISTINCT FROM f.{columns[0]} AND t.pos = f.{columns[1]} // {16**k})""")
        return parts

    inner, inner_proof = climb("s", "a.g", "a.pos")
    outer, outer_proof = climb("t", "0", "b.pos")
    last = _LEVELS - 1
    return ",\n".join(
        [
            f"""WITH leaves AS (SELECT source AS g, doc_id, sha256({head} || {encoded("text")}) AS d,
              CASE WHEN coalesce({crc} % 5 = 0, false) THEN sha256({head} || {encoded(low)}) END AS changed FROM documents)""",
            """placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
              count(*) OVER (PARTITION BY g) AS n FROM leaves)""",
            *tree("s", "placed"),
            f"subroots AS (SELECT g AS source, d FROM sup{last})",
            """tops AS (SELECT 0 AS g, source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
              count(*) OVER () AS n FROM subroots)""",
            *tree("t", "tops"),
            f"""joined AS (SELECT a.doc_id, a.d AS leaf, b.d AS subroot, (SELECT d FROM tup{last}) AS root, a.g AS g, a.pos AS pos,
              0 AS zero, b.pos AS top_pos, coalesce(a.changed, a.d) AS f, sha256({inner_proof} || {outer_proof}) AS proof_sha256
              FROM placed a JOIN tops b ON b.source IS NOT DISTINCT FROM a.g {inner} {outer})""",
            *fold("s", ["g", "pos"], "joined"),
            *fold("t", ["zero", "top_pos"], f"joined_s{last}"),
        ]
    ) + f"""
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM joined_s{last}_t{last}"""


OP13_SQL = _sql()
