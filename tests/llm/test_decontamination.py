import hashlib
import re

from helpers import ODD, SF, documents, read

from tidemark.llm import decontamination


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(text, items, width=13):
    w = words(text)
    hit, found = set(), set()
    for item, item_text in items:
        iw = words(item_text)
        size = min(width, len(iw))
        for i in range(len(iw) - size + 1 if size else 0):
            for p in range(len(w) - size + 1):
                if w[p : p + size] == iw[i : i + size]:
                    hit.update(range(p, p + size))
                    if item is not None:
                        found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def run(spark, docs, items):
    got = decontamination.decontaminate(docs, decontamination.prepare(docs, items)).collect()
    return [(r.doc_id, (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got]


def test_documents(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    listed = list(zip(read("benchmark").item_id.tolist(), read("benchmark").text))
    some = read("documents").set_index("doc_id").text
    got = dict(run(spark, docs, items))
    assert len(got) == len(some)
    marked = [i for i, r in got.items() if r[1]]
    assert marked
    for i in marked[:15] + [i for i in got if not got[i][1]][:15]:
        assert got[i] == brute_force(some[i], listed)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 7)
    passage = " ".join(f"w{i}" for i in range(20))
    rows = ODD + [
        (20, f"Before {passage.upper()}, after!", "en", "a"),
        (21, passage + " " + passage, "en", "a"),
        (22, " ".join(f"w{i}" for i in range(12)), "en", "a"),
        (23, "x " * 500 + passage, "en", "a"),
        (24, "tiny item", "en", "a"),
        (25, "The the THE the", "en", "a"),
    ]
    items = [
        (1, passage), (1, passage), (2, " ".join(f"w{i}" for i in range(5, 18))), (3, "Tiny, item"), (4, None), (5, ""),
        (6, "... !!!"), (None, passage), (7, "the the"), (8, "日本語 text"), (10, "word " * 30),
    ]
    docs = documents(spark, rows, clashing=True)
    listed = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS word", "1 AS n", "'z' AS window")
    got = run(spark, docs, listed)
    fast = [r for r in rows if r[0] != 5]
    key = lambda x: (x[0] is None, x[0] or 0)
    want = sorted(((i, brute_force(t, items)) for i, t, _, _ in fast), key=key)
    assert sorted((g for g in got if g[0] != 5), key=key) == want
    assert dict(got)[5][:3] == (60_000, 60_000, 1)
    searcher = decontamination.prepare(docs, listed)
    kept = decontamination.clean(docs, searcher)
    clean = sorted((i for i, r in got if not r[4]), key=lambda x: (x is None, x or 0))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0)) == clean


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r[1] == 0 and not r[4] for _, r in run(spark, documents(spark, ODD), none))
    assert run(spark, documents(spark, []), none) == []
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert run(spark, documents(spark, []), some) == []
