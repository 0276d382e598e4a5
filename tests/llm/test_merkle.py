import hashlib
import zlib

from pyspark.sql import functions as F

from voltmart.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """The last node, and for each place the (before, after) siblings up to it."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, place in enumerate(at):
            run, slot = runs[place // fanout], place % fanout
            steps[k].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[k] = place // fanout
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], steps


def brute_force(rows, fanout=16):
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    found, tops = [], []
    for name in names:
        part = sorted(trees[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        top, steps = climb([leaf(r, r["text"]) for r in part], fanout)
        tops.append(top)
        found.append((part, steps))
    root, upper = climb(tops, fanout)
    for top, above, (part, steps) in zip(tops, upper, found):
        for row, own in zip(part, steps):
            path, text = own + above, row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf(row, text)
            for before, after in path:
                folded = h(before + folded + after)
            yield (
                row["doc_id"], leaf(row, row["text"]), top, root, h("".join(a + b for a, b in path)), folded, folded == root
            )


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(docs, fanout=16):
    found = merkle.verify(docs, *merkle.lowered_where_checked(docs), fanout=fanout)
    got = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute_force([r.asDict() for r in docs.collect()], fanout), key=repr)
    return found


def test_whole_table(sample):
    found = check(sample)
    assert 0 < found.filter("NOT verified").count() < sample.count() / 4


def test_several_levels_and_uneven_sources(spark):
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"Ü{i % 41}", "en", i, f"Text {i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    check(docs)
    check(docs, fanout=2)


def test_nulls_copies_and_clashing_columns(odd_docs, no_docs):
    check(odd_docs.withColumnsRenamed({"fp": "tree", "tag": "pos", "key": "n", "spans": "path"}).withColumn("leaf", F.lit(1)))
    assert merkle.verify(no_docs, *merkle.lowered_where_checked(no_docs)).count() == 0


def test_one_document_is_its_own_root(odd_docs):
    row = check(odd_docs.filter("doc_id = 5").withColumn("root", F.lit("x"))).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("")
