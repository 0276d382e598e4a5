import random
import re
import time

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import texts_of
from voltmart.llm import decontaminate, html, langid, licenses, quality, toxicity


# --- decontamination -------------------------------------------------------------------------------------------------


def brute_hits(text, items, window):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, found = set(), set()
    for item, item_text in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in item_text or ""))
        n = min(window, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("window,block", [(13, 200_000), (3, 200_000), (4, 15)])
def test_scan_equals_brute_force(spark, odd_docs, window, block):
    texts = dict(texts_of(odd_docs))
    items = [(1, " ".join(texts[4].split()[5:30])), (2, "ta"), (3, None), (4, ""), (5, "riTA, no"), (5, texts[100]),
             (None, texts[101]), (10, texts[10][500:900]), (11, texts[10][700:1200])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.scan(odd_docs, benchmark, window, block).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found), key=repr)
    assert got == sorted(((i, *brute_hits(t, items, window)) for i, t in texts_of(odd_docs)), key=repr)


def test_decontaminate_drops_and_cuts(spark, odd_docs, no_docs):
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, "Before, " + " ".join(words[50:70]) + " after"), (3, "clean text"), (4, None)],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([("a", " ".join(words[52:66]))], "item_id string, text string")
    kept = dict(texts_of(decontaminate.decontaminate(docs, benchmark)))
    assert set(kept) == {1, 3, 4} and kept[3] == "clean text" and kept[4] is None
    assert "w51" in kept[1] and "w66" in kept[1] and "w52 " not in kept[1] and "w65" not in kept[1]
    assert decontaminate.decontaminate(odd_docs, benchmark).columns == odd_docs.columns
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.decontaminate(odd_docs, none).count() == odd_docs.count()
    assert decontaminate.scan(no_docs, benchmark).count() == 0


def test_coverage_is_exact_at_the_limit(spark):
    found = spark.createDataFrame([(7, 140), (7, 141), (0, 0)], "n_hit long, n_words long").withColumn("longest", F.lit(0))
    assert [r.contaminated for r in decontaminate.verdicts(found).orderBy("n_words").collect()] == [False, True, False]


# --- language --------------------------------------------------------------------------------------------------------


def test_profiles_rank_by_count_then_code():
    codes = langid.letter_codes("abab", langid._letters())
    got = langid.profile(codes, 100)
    grams, counts = np.unique(langid.ngrams(codes), return_counts=True)
    assert got.tolist() == [g for _, g in sorted(zip(-counts, grams))]
    blocks = langid.counted(langid.letter_codes("La maison est là. " * 50, langid._letters()), block=37)
    whole = np.unique(langid.ngrams(langid.letter_codes("La maison est là. " * 50, langid._letters())), return_counts=True)
    assert blocks[0].tolist() == whole[0].tolist()
    assert blocks[1].tolist() == whole[1].tolist()


def test_languages_of_held_out_documents(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.98 and found.score.between(0, 1).all()
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd_docs).collect()}
    assert odd[0] == odd[1] == odd[2] == odd[7] == ("und", 0.0) and odd[10][0] in ("es", "en", "nl")
    assert langid.identify(odd_docs).count() == odd_docs.count() and langid.identify(no_docs).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang").limit(5)
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_article_after_a_script_with_a_comparison(spark):
    """``i<n`` in a script is no tag; nor is one inside the head."""
    script = "<script>for(i=0;i<n;i++){a[i]='\\''}</SCRIPT >"
    article = "<article><p>" + "It was the first of the things that we had in the house. " * 4 + "</p>"
    rest = "<p>" + "And this is what there was to be seen of it on the next day. " * 4 + "</p></article>"
    for page in (script + article + rest, article + script + rest, f"<head><title>a<b</title>{script}</head><body>{article}{rest}"):
        found = html.main_text(page)
        assert "first of the things" in found and "on the next day" in found and "i++" not in found
    assert "next day" not in html.main_text(article + "<script>i<n" + rest)


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_held_out_toxicity(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert found.score.between(0, 1).all() and ((found.score >= 0.3) == (found.predicted == 1)).all()
    toxic = found[found.toxic == 1].score.to_numpy()
    ordinary = found[found.toxic == 0].score.to_numpy()
    assert (toxic[:, None] > ordinary[None, :]).mean() > 0.9
    assert toxicity.scores(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert toxicity.scores(no_docs, labels.limit(0)).count() == 0
    assert toxicity.keep_ordinary(odd_docs, labels.limit(0)).columns == odd_docs.columns


@pytest.mark.parametrize("marks", [[], [(i, 0) for i in range(12)], [(i, 1) for i in range(12)], [(10**9, 0), (10**9 + 1, 1)]])
def test_nothing_is_toxic_without_labels_of_both_classes(spark, odd_docs, marks):
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.scores(odd_docs, labels).collect()} == {(0.0, 0)}
    assert toxicity.keep_ordinary(odd_docs, labels).count() == odd_docs.count()


def test_texts_without_words_are_not_toxic(spark):
    rows = [(i, "vile words here" if i % 2 else "kind words here") for i in range(200)] + [(500, ""), (501, None), (502, "#!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    found = {r.doc_id: (r.score, r.predicted) for r in toxicity.scores(docs, labels).collect()}
    assert found[500] == found[501] == found[502] == (0.0, 0)


def test_rare_words_of_the_sample_count_by_their_own_share_of_all_texts(spark):
    """A word seen once in toxic texts favours toxicity more than an unseen one, and more so the rarer it is elsewhere."""
    rows = [(i, f"w{i % 7} w{i % 5} w{i % 3} " + ("once" if i == 1 else "usual" if i == 3 else "")) for i in range(40)]
    rows += [(100 + i, f"z{i} usual") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sent, _ = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    model = sent.value
    once, usual, unseen = (model.ratio(toxicity.word_ids(w))[1, 0] for w in ("once", "usual", "never"))
    assert not held_out_ids({1, 3}) and once > usual > unseen
    ids = toxicity.word_ids("once usual")
    counts = dict(zip(ids.tolist(), toxicity.shared_counts(docs, np.sort(ids))[np.argsort(np.argsort(ids))].tolist()))
    assert counts == {int(ids[0]): 1, int(ids[1]): 61}


def held_out_ids(ids):
    return {i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2}


# --- quality ---------------------------------------------------------------------------------------------------------


def test_quality_of_odd_documents(odd_docs, no_docs):
    rows = {r.doc_id: r for r in quality.assess(odd_docs).collect()}
    assert [rows[0].n_words, rows[1].n_words, rows[2].n_words] == [0, 0, 0] and not rows[1].kept
    lines = rows[8]
    assert (lines.n_words, lines.n_dup_lines, lines.n_repeat_words, lines.base_failed) == (80, 39, 80, True)
    assert rows[7].n_symbols == 7 and rows[7].word_chars == 7
    assert rows[10].kept and not rows[10].base_failed and rows[10].n_words == 6000
    assert quality.assess(odd_docs).count() == odd_docs.count() and quality.assess(no_docs).count() == 0


def test_cascade_order_does_not_change_verdicts(sample):
    verdict = lambda rules: {r.doc_id: r.kept for r in quality.assess(sample, rules).collect()}
    assert verdict(quality.RULES) == verdict(tuple(reversed(quality.RULES)))
    never = quality.Rule("never", "1", "value > 1")
    often = quality.Rule("often", "n_words", "value > 0")
    assert [r.name for r in quality.cascade(sample, (never, often))] == ["often", "never"]


# --- pages -----------------------------------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>The home of all</a></li></ul></nav>
<div class="cookie-notice">We and our partners use cookies and that is what it is for all of you.</div>
<div id=content><h2>Title &amp; more</h2><p>It was in the morning that we went to the river, and there was a boat on it that she had not
seen before, so we took it for the day.<p>Short one.</p><pre>a
  b</pre></div>
<div class="comments"><p>I think that this is the best of all the things that I have read on the web this week, so thanks.</p></div>
<form>Name <input></form><aside>And this is what you should also read, as it is one of the best.</aside><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE).split("\n") == [
        "Title & more",
        "It was in the morning that we went to the river, and there was a boat on it that she had not seen before, so we took "
        "it for the day.", "Short one.", "a b",
    ]
    assert [html.main_text(p) for p in (None, "", "<p>", "<script>x", "<a href='")] == [""] * 5


def test_articles_of_the_given_pages(spark):
    import html as references

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    assert len(got) == pages.count()
    for page in pages.collect():
        article = re.search("<article>(.*?)</article>", page.html, re.S)
        if article:
            blocks = re.split(r"</?(?:p|h1|br|div|ul|li)\b[^>]*>", article[1])
            lines = [re.sub(r"\s+", " ", references.unescape(re.sub("<[^>]*>", "", b))).strip() for b in blocks]
            assert got[page.page_id].text == "\n".join(x for x in lines if x)
            assert got[page.page_id].n_chars == len(got[page.page_id].text)


# --- licenses --------------------------------------------------------------------------------------------------------


def test_licenses_are_found_with_edits(spark, odd_docs, no_docs):
    mit = licenses.TEMPLATES["MIT"].split()
    edited = mit[:20] + ["extra", "words"] + mit[22:]
    docs = spark.createDataFrame(
        [(1, "Über uns. " + " ".join(edited) + " Ende"), (2, "Released under the MIT Licence"), (3, None), (4, " ".join(mit[:20])),
         (5, "x Released under the MIT License. y Released under the MIT License.")],
        "doc_id long, text string",
    )
    rows = licenses.scan(docs).collect()
    found = {(r.doc_id, r.license): r for r in rows}
    assert {(1, "MIT"), (5, "MIT-notice")} <= set(found) and not any(r.doc_id in (3, 4) for r in rows)
    whole = found[(1, "MIT")]
    text = docs.filter("doc_id = 1").first().text
    assert text[whole.start_char : whole.end_char].startswith("Permission is") and text[: whole.end_char].endswith("Software")
    assert whole.n_aligned == len(licenses.words_of(licenses.TEMPLATES["MIT"])) - 2
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert [r.license for r in licenses.scan(odd_docs).collect()] == ["CC-BY-NC-4.0-notice"]
    assert licenses.scan(no_docs).count() == 0


def test_band_finds_what_full_alignment_finds(sample):
    index = licenses.Index(licenses.TEMPLATES)
    for _, text in texts_of(sample)[:60]:
        ids = licenses._ids(licenses.words_of(text))
        got = {(m[0], m[1], m[2]) for m in index.matches(ids, 1.0)}
        exact = set()
        for name, words in zip(index.names, index.words):
            n = len(words)
            exact |= {(name, i, i + n) for i in range(len(ids) - n + 1) if (ids[i : i + n] == words).all()}
        assert got == exact


def full_alignment(template, region):
    """Best local alignment without a band: (score, aligned words)."""
    best, before = (0, 0), [(0, 0)] * (len(region) + 1)
    for word in template:
        row = [(0, 0)]
        for j, other in enumerate(region):
            options = [(0, 0), (before[j + 1][0] - 1, before[j + 1][1]), (row[j][0] - 1, row[j][1])]
            step = (2, 1) if word == other else (-1, 0)
            options.append((before[j][0] + step[0], before[j][1] + step[1]))
            top = max(options)
            row.append(top if top[0] > 0 else (0, 0))
        best, before = max(best, *row), row
    return best


def test_edited_notices_align_as_without_a_band():
    rng = random.Random(5)
    index = licenses.Index(licenses.TEMPLATES)
    for t, name in enumerate(index.names):
        words = licenses.words_of(licenses.TEMPLATES[name])
        for _ in range(4):
            edited = list(words)
            for _ in range(max(1, len(words) // 14)):
                k = rng.randrange(len(edited))
                edited[k : k + 1] = rng.choice([[], [b"other"], [edited[k], b"more"]])
            ids = licenses._ids([b"before"] * rng.randrange(40) + edited + [b"after"] * rng.randrange(9))
            score, aligned = full_alignment(index.words[t].tolist(), ids.tolist())
            assert licenses.align(index.words[t], ids, -len(words), len(ids))[0] == aligned
            if aligned >= 0.8 * len(words) and len(words) > 5:
                found = index._of_template(t, ids, index_hits(index, t, ids), 0.8)
                assert [m[2] for m in found] == [aligned], name


def index_hits(index, t, ids):
    hits = np.concatenate([p.hits(ids) for p in index.prints])
    hits = hits[hits[:, 0] == t, 1:]
    return hits[np.argsort(hits[:, 1], kind="stable")]


def test_each_template_is_found_as_itself():
    known = licenses.templates()
    index = licenses.Index(known)
    for name, text in known.items():
        ids = licenses._ids(licenses.words_of("Some words before. " + text + " And some after it."))
        found = index.matches(ids, 0.8)
        assert [(m[0], m[5]) for m in found] == [(name, 1.0)], name


def test_repeated_notices_take_linear_time():
    index = licenses.Index(licenses.templates())
    one = licenses.words_of("Released under the MIT License.") + [b"x"]
    begin = time.process_time()
    found = index.matches(licenses._ids(one * 3000), 0.8)
    assert [m[1:3] for m in found] == [(6 * i, 6 * i + 5) for i in range(3000)] and {m[0] for m in found} == {"MIT-notice"}
    text = licenses.words_of(licenses.templates()["GPL-2.0-text"])
    found = index.matches(licenses._ids(text * 5), 0.8)
    assert [m[0] for m in found] == ["GPL-2.0-text"] * 5
    assert time.process_time() - begin < 60


def test_rules_are_ordered_by_rejections_per_cost():
    a, b, c, d = (quality.Rule(n, "1", "false") for n in "abcd")
    assert quality.ordered((a, b, c, d), [0, 10, 40, 0], [0.1, 0.1, 0.1, 0.01]) == [c, b, d, a]
    assert quality.ordered((a, b, c, d), [10, 10, 11, 10], [0.8, -0.01, 0.1, 0.1])[0] == b  # cheaper than can be told
    assert quality.ordered((a, b), [100, 101], [0.1, 0.1]) == [a, b]
    assert quality.ordered((a, b), [5, 5], [0.0, 0.0]) == [a, b] and quality.ordered((), [], []) == []
