"""Prefix trie, invertible sketches and Merkle manifest, against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from helpers import ODD, SF, documents
from pyspark.sql import functions as F

from tidemark.llm import invertible_sketch, merkle, prefix_trie, tree_contraction
from tidemark.llm.ordering import numbered

TURNS = "conv_id long, turn long, role string, text string"


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def plain_trie(rows, heads=9):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            given[conv].append(((turn is not None, turn or 0), digest, role, text))
    given = {c: [t[2:] for t in sorted(turns)] for c, turns in given.items()}
    rebuilt = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = tuple(given.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        below = [total[p] for p in children[path]]
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        total[path] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + own)
    rows = []
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if rebuilt[c] == path)))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(who), len(path), parent, len(who), len(children[path]), *total[path], digest))
    return in_order(rows)


def check_trie(spark, rows, **options):
    df = spark.createDataFrame(rows, TURNS)
    assert in_order(prefix_trie.prefix_trie(df, **options).collect()) == plain_trie(rows)


def test_trie_of_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert in_order(prefix_trie.prefix_trie(df).collect()) == plain_trie(list(map(tuple, df.collect())))


def test_trie_with_a_hot_turn_and_a_long_conversation(spark):
    rng = random.Random(3)
    rows = [(c, t, "user", "hello" if t == 0 else f"x{rng.randrange(3)}") for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(1_000, t, "user", f"line {t % 7}") for t in range(150)]
    rows += [(1_001, t, "user", f"line {t % 7}") for t in range(140)]
    check_trie(spark, rows, piece=8, heavy=4)


def test_trie_of_odd_rows(spark):
    rows = [
        (7, None, None, None), (7, 1, "user", None), (7, 1, None, "tie"), (7, 1, None, "tie"), (7, 2, "user", "é" * 70_000),
        (-3, 0, "user", "negative"), (0, 0, "user", "base"), (0, 1, "user", "ü"), (2, 0, "user", "base"),
        (None, 0, "user", "no conversation"), (9, 5, "", ""), (10, -1, "user", "first"), (10, 3, "user", "last"),
    ]
    check_trie(spark, rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    clashing = spark.createDataFrame(rows, TURNS).selectExpr("*", *[f"1 AS {c}" for c in ("depth", "a", "pos", "members", "c", "kids")])
    assert in_order(prefix_trie.prefix_trie(clashing).collect()) == plain_trie(rows)


@pytest.mark.parametrize("shape", ["path", "star", "random", "forest"])
def test_subtree_totals(spark, shape):
    rng = random.Random(shape)
    n = 120
    parent = {i: {"path": i - 1, "star": 0, "random": rng.randrange(max(i, 1)), "forest": i // 3 * 3 if i % 3 else None}[shape] for i in range(n)}
    if shape != "forest":
        parent[0] = None
    kids = defaultdict(list)
    for i, p in parent.items():
        if p is not None:
            kids[p].append(i)
    value = {i: rng.randrange(100) for i in range(n)}
    total = dict(value)
    for i in range(n - 1, 0, -1):
        if parent[i] is not None:
            total[parent[i]] += total[i]
    rows = []
    for i, p in parent.items():
        kc = 0
        for k in kids[i]:
            kc ^= k
        rows.append((i, 5, p, None if p is None else 5, len(kids[i]), kc, 5 * (len(kids[i]) % 2), value[i]))
    df = spark.createDataFrame(rows, "c long, d long, pc long, pd long, kids long, kc long, kd long, v long")
    assert {r.c: r.v for r in tree_contraction.subtree_totals(df, ["v"]).collect()} == total


def paragraphs(text):
    return {q for q in (p.strip(" ") for p in text.split("\n")) if q}


def plain_edits(rows):
    """``rows``: (id, text) in their order."""
    found = []
    for at, (i, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        near = []
        for other in (edited, following):
            a, b = paragraphs(text), paragraphs(other)
            near.append(len(a & b) / len(a | b) if a | b else 1.0)
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return in_order(found)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


def test_fingerprints_of_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(((r.doc_id, r.text) for r in df.collect()), reverse=True)
    for per_piece in (2_000, 30):
        prints = invertible_sketch.fingerprints(df, per_piece).collect()
        assert in_order([r[c] for c in COLUMNS] for r in prints) == plain_edits(rows)
    text = dict(rows)
    same = defaultdict(set)
    for r in prints:
        same[text[r.doc_id]].add(r.fingerprint)
    assert all(len(s) == 1 for s in same.values()) and len(same) < len(prints)


def test_fingerprints_of_many_lines_and_hot_ids(spark):
    rng = random.Random(5)
    long = [(i, "\n".join(f"line {rng.randrange(4_000)}" for _ in range(1_500))) for i in (900, 901)]
    # an id with most rows, all of them alike, so that any order gives the same result
    rows = long + [(500, "a\nb\nc")] * 150 + [(i, f"x{i}\ny\nz{i % 3}") for i in range(40)] + [(None, "none\nat all")]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    prints = invertible_sketch.fingerprints(documents(spark, [(*r, "en", "a") for r in rows]), 10).collect()
    assert in_order([r[c] for c in COLUMNS] for r in prints) == plain_edits(order)


def test_fingerprints_of_odd_rows(spark):
    for clashing in (False, True):
        prints = invertible_sketch.fingerprints(documents(spark, ODD, clashing)).collect()
        assert sorted(r.n_chars for r in prints) == sorted(len(t or "") for _, t, *_ in ODD)
        blank = [r for r in prints if r.doc_id in (1, 2)]
        assert {r.fingerprint.replace(",", "") for r in blank} == {""}
    assert invertible_sketch.fingerprints(documents(spark, [])).collect() == []
    alone = invertible_sketch.fingerprints(documents(spark, [(4, "one\ntwo", "en", "a")])).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in alone] == plain_edits([(4, "one\ntwo")])


def test_differences_are_recovered(spark):
    rng = random.Random(9)
    sets = [(i, rng.sample(range(10**6), n), rng.sample(range(10**6), m)) for i, (n, m) in enumerate([(0, 0), (3, 0), (0, 40), (900, 800)])]
    sets += [(9, list(range(1_000)), list(range(5, 1_003)))]
    df = spark.createDataFrame(sets, "pair long, one array<long>, two array<long>")
    gone, came = defaultdict(set), defaultdict(set)
    for r in invertible_sketch.differences(df).collect():
        gone[r.pair].update(r.gone)
        came[r.pair].update(r.came)
    for i, one, two in sets:
        assert gone[i] == set(one) - set(two) and came[i] == set(two) - set(one)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return sha(*map(told, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def plain_tree(hashes):
    """Root and, for each leaf, its siblings: (left, hash or None)."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, p in enumerate(at):
            other = p + 1 if p % 2 == 0 else p - 1
            paths[i].append((p % 2 == 1, level[other] if other < len(level) else None))
            at[i] = p // 2
        level = [sha(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def plain_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        groups.append((own, *plain_tree([plain_leaf(r) for r in own])))
    root, tops = plain_tree([g[1] for g in groups])
    found = []
    for (own, subroot, paths), top in zip(groups, tops):
        for row, path in zip(own, paths):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = plain_leaf(row, 1 if tampered else 0)
            for left, other in path + top:
                folded = sha(folded) if other is None else sha(other, folded) if left else sha(folded, other)
            proof = sha(*[h for _, h in path + top if h])
            found.append((row[0], plain_leaf(row), subroot, root, proof, folded, folded == root))
    return in_order(found)


@pytest.mark.parametrize("options", [{}, {"hop": 2, "piece": 16}, {"hop": 1, "piece": 3}])
def test_manifest_of_documents(spark, options):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(10**9 if not options else 70)
    df = spark.createDataFrame(df.collect(), df.schema)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]
    got = in_order(merkle.manifest(df, **options).collect())
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_odd_rows(spark):
    odd = [*ODD, (21, "many", "l1", "a"), (22, "groups", "l2", "a"), (28, "here", "", "a"), (None, "also", None, None)]
    for clashing in (False, True):
        df = documents(spark, odd, clashing)
        rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]
        assert in_order(merkle.manifest(df, hop=2).collect()) == plain_manifest(rows)
    df = df.selectExpr("doc_id", "text", "lang", "source", "CASE WHEN doc_id > 6 THEN n_chars END AS n_chars")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]
    assert in_order(merkle.manifest(df).collect()) == plain_manifest(rows)
    assert merkle.manifest(documents(spark, [])).collect() == []
    one = documents(spark, [(3, "alone", "en", "a")])
    assert in_order(merkle.manifest(one).collect()) == plain_manifest([(3, "alone", "en", "a", 5)])


def test_numbers_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(20)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = numbered(df, "g", [F.col("v").asc_nulls_first()], "test", 50).collect()
    for g in ("a", "b", None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.pos)
        assert [r.pos for r in mine] == list(range(len(mine))) and {r.members for r in mine} == {len(mine)}
        assert [r.v for r in mine] == sorted((v for h, v in rows if h == g), key=lambda v: (v is not None, v or 0))
