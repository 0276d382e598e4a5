"""Merkle manifest of a dataset: a tree of digests per group, a tree over the groups, and an inclusion proof per row.

Slot pivot: conditional aggregates spread the children of each parent into one column per slot. The concatenated columns
are the parent's input; without the own slot's column they are a child's siblings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.llm.common import map_batches
from voltmart.session import materialize

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<before:string,after:string>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 over the values: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in the tree from 0, and ``n``, the number of rows of the tree.

    Rows are sorted by range over all tasks and written. Counts of a tree's rows in the tasks before, at most one row per
    task and tree, make the places of a task's first rows. So a tree may be spread over any number of tasks.
    """
    rows = rows.withColumn("_nth", F.monotonically_increasing_id())
    names = [c for c in rows.columns if c != "_nth"]
    spread = rows.repartitionByRange(F.col(tree), *[F.col(c) for c in order], F.col("_nth")).sortWithinPartitions(
        tree, *order, "_nth"
    )
    placed = materialize(map_batches(spread.select(*names), _places(tree, names), _schema(rows, names) + ", _part int, _at long"))
    counts = placed.groupBy("_part", tree).agg(F.count("*").alias("_n"))
    of_tree = Window.partitionBy(tree)
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(counts.select(
        F.col("_part").alias("_of_part"), F.col(tree).alias("_of_tree"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(of_tree).alias("n"),
    ))
    same = (F.col("_part") == F.col("_of_part")) & F.col(tree).eqNullSafe(F.col("_of_tree"))
    return placed.join(bases, same).select(*names, (F.col("_at") + F.col("_base")).alias("pos"), "n")


def _schema(rows: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)


def _places(tree: str, names: Sequence[str]):
    """Numbers the rows of each tree within one sorted task; only the tree and its count are carried on."""

    def run(batches):
        from pyspark import TaskContext

        part, current, at, begun = TaskContext.get().partitionId(), None, 0, False
        for batch in batches:
            places = []
            for value in batch.column(tree).to_pylist():
                if not begun or value != current:
                    current, at, begun = value, 0, True
                places.append(at)
                at += 1
            yield {c: batch.column(c) for c in names} | {"_part": [part] * len(places), "_at": places}

    return run


def _slots(fanout: int) -> list[str]:
    return [f"c{i}" for i in range(fanout)]


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Parents above ``nodes`` (tree, pos, n, digest), lowest level first: tree, pos, n, digest and a column per slot.

    A level holds the trees that had several nodes below it. The number of levels is the logarithm of the largest tree.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    found = []
    while most > 1:
        parents = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / fanout).alias("pos")).agg(
            F.ceil(F.max("n") / fanout).alias("n"),
            *[F.max(F.when(F.col("pos") % fanout == i, F.col("digest"))).alias(c) for i, c in enumerate(_slots(fanout))],
        )
        nodes = materialize(parents.withColumn("digest", F.sha2(F.concat_ws("", *_slots(fanout)), 256)))
        found.append(nodes)
        most = -(-most // fanout)
    return found


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's last node."""
    found = nodes.filter("n = 1").select("tree", "digest")
    for level in levels:
        found = found.union(level.filter("n = 1").select("tree", "digest"))
    return found


def _step(slot: Column, fanout: int) -> Column:
    """The siblings of ``slot`` before and behind it, from the slot columns."""
    before = [F.when(F.lit(i) < slot, F.col(c)) for i, c in enumerate(_slots(fanout))]
    after = [F.when(F.lit(i) > slot, F.col(c)) for i, c in enumerate(_slots(fanout))]
    return F.struct(F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))


def _same(tree: str = "tree", pos: str = "pos") -> Column:
    return F.col(tree).eqNullSafe(F.col("_tree")) & (F.col(pos) == F.col("_pos"))


def _below(levels: list[DataFrame], above: DataFrame | None, fanout: int) -> DataFrame:
    """(_tree, _pos, slot columns, path) of the lowest parents; path: the steps from the parent up to the root.

    ``above`` (tree, path) holds the steps of each tree's last node; none of them are needed for the last tree.
    """
    paths = None
    for level in reversed(levels):
        top = level.filter("n = 1").select("tree", "pos")
        if above is None:
            top = top.withColumn("path", F.array().cast(f"array<{_STEP}>"))
        else:
            top = top.join(above.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).select(
                "tree", "pos", "path"
            )
        if paths is not None:
            slot = F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("slot")
            children = paths.select("*", slot)
            child = F.coalesce(*[F.when(F.col("slot") == i, F.col(c)) for i, c in enumerate(_slots(fanout))])
            top = top.union(children.filter(child.isNotNull()).select(
                F.col("_tree").alias("tree"), (F.col("_pos") * fanout + F.col("slot")).alias("pos"),
                F.concat(F.array(_step(F.col("slot"), fanout)), F.col("path")).alias("path"),
            ))
        parents = level.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), *_slots(fanout))
        paths = materialize(top.join(parents, _same()).select("_tree", "_pos", *_slots(fanout), "path"))
    return paths


def _with_path(nodes: DataFrame, levels: list[DataFrame], above: DataFrame | None, fanout: int) -> DataFrame:
    """``nodes`` with ``path``, their steps up to the root; a tree's only node has those of its tree alone."""
    none = F.array().cast(f"array<{_STEP}>")
    alone = nodes.filter("n = 1")
    if above is None:
        alone = alone.withColumn("path", none)
    else:
        alone = alone.join(above.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    if not levels:
        return alone
    joined = nodes.filter("n > 1").withColumn("_up", F.floor(F.col("pos") / fanout)).join(
        _below(levels, above, fanout), _same("tree", "_up")
    )
    step = _step(F.col("pos") % fanout, fanout)
    return alone.unionByName(joined.withColumn("path", F.concat(F.array(step), F.col("path"))).select(*nodes.columns, "path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["before"], digest, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, from the leaf's to the root's children."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` (tree, id, leaf, any other columns but pos, n, path) with ``subroot``, ``root`` and ``path``.

    Leaves of a tree ascend by id, nulls first, equal ids by digest; every ``fanout`` nodes in order, or what is left of
    them, become one node until one remains. The trees' last nodes, by tree (null first, bytewise), make the root
    likewise. Repeated rows are leaves each, in any order, as they are equal. An empty table gives an empty result. A leaf
    that is its tree's only one is the subroot. ``path`` lists per level the siblings before and behind the node.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    rest = [c for c in leaves.columns if c not in ("tree", "id", "leaf")]
    nodes = materialize(_numbered(leaves, "tree", ["id", "leaf"]).withColumnRenamed("leaf", "digest"))
    levels = _levels(nodes, fanout)
    tops = materialize(_tops(nodes, levels)).select(F.lit(0).alias("tree"), F.col("tree").alias("of"), "digest")
    heads = materialize(_numbered(tops, "tree", ["of"]))
    upper = _levels(heads, fanout)
    root = _tops(heads, upper).first()
    above = materialize(_with_path(heads, upper, None, fanout).select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"),
        F.lit(root["digest"] if root else None).cast("string").alias("root"), "path",
    ))
    placed = _with_path(nodes, levels, above.select("tree", "path"), fanout).select(
        "tree", "id", F.col("digest").alias("leaf"), *rest, "path"
    )
    named = above.select(F.col("tree").alias("_tree"), "subroot", "root")
    return placed.join(named, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")


def verify(
    docs: DataFrame, tampered: Column, changed: Column, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id",
    tree_col: str = "source", text_col: str = "text", fanout: int = FANOUT,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of ``docs``.

    The manifest is built of the rows as they are. ``folded_root`` follows the proof from the row as it is found: with
    ``changed`` in place of the text where ``tampered`` holds. ``tree_col`` is taken as text; nulls of any column have a
    digest of their own, an empty text differs from a null, and texts of any length are hashed where they lie.
    """
    found = [changed if c == text_col else docs[c] for c in columns]
    leaves = materialize(docs.select(
        docs[tree_col].cast("string").alias("tree"), docs[id_col].cast("long").alias("id"),
        leaf_digest([docs[c] for c in columns]).alias("leaf"),
        F.when(tampered, leaf_digest(found)).alias("tampered_leaf"),
    ))
    rows = manifest(leaves, fanout)
    folded = fold(F.coalesce("tampered_leaf", "leaf"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered_where_checked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """The trial tampering: where 5 divides the id's CRC-32, A-Z of the text become a-z. A null id is left alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = F.crc32(docs[id_col].cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False)), F.translate(docs[text_col], upper, upper.lower())
