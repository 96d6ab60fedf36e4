"""Exact, near and substring dedup, and mixing, against brute force on small odd tables."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagewright.llm import components, exact_dedup, mixing, simhash, substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "clash", "clash", "clash") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{k % 977}x{k}" for k in range(30_000))
    near = " ".join(f"tok{k}" for k in range(400))
    rows = [(1, None, "a"), (2, "", None), (3, "Same Text é", "a"), (4, "sAME tEXT é", "b"), (4, "sAME tEXT é", "b"), (5, "same text É", "b"), (None, "same text é", "a"), (None, "only null", None), (6, long, "a"), (7, long.upper(), "c")]
    rows += [(8, near, "c"), (9, near.replace("tok7 ", "tokx "), "c"), (10, " \t\n", "a"), (11, "one two", "a"), (11, "one two", "a")]
    return rows


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact(spark, odd):
    got = exact_dedup.exact_groups(table(spark, odd)).collect()
    groups = defaultdict(list)
    for i, t, _ in odd:
        groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(i)
    want = sorted((str(i), str(max((x for x in g if x is not None), default=None)), len(g), h) for h, g in groups.items() for i in g)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    kept = defaultdict(list)
    for r in got:
        kept[r["text_sha256"]] += [r] * r["kept"]
    assert all(len(v) == 1 and v[0]["doc_id"] == v[0]["keep_id"] for v in kept.values()) and len(kept) == len(groups)
    left = exact_dedup.drop_exact(table(spark, odd))
    assert left.columns == DOCS.replace(" long", "").replace(" string", "").split(", ") and left.count() == len(groups)


def brute_fp(t):
    words = lower(t).encode().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return label


def test_simhash(spark, odd):
    got = simhash.near_groups(table(spark, odd)).collect()
    fps = [brute_fp(t) for _, t, _ in odd]
    label = brute_components(fps)
    least = {x: min((odd[k][0] for k in range(len(odd)) if label[k] == x and odd[k][0] is not None), default=None) for x in label}
    want = sorted((str(odd[k][0]), fps[k], str(least[label[k]])) for k in range(len(odd)))
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in got) == want
    left = simhash.drop_near(table(spark, odd))
    assert left.count() == len(set(label)) and len(left.columns) == 8


def test_spark_hash_is_the_fingerprints_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b é d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b é d".encode(), 42)


@pytest.mark.parametrize("large", [simhash.LARGE, 1])
def test_chains_and_families_are_found(spark, monkeypatch, large):
    """Fingerprints a few bits apart, in chains and crowded families: components by the operator's lists equal brute force."""
    monkeypatch.setattr(simhash, "LARGE", large)  # 1: lists that show a fingerprint or more are taken apart once more
    monkeypatch.setattr(simhash, "SHOWN", simhash.SHOWN if large > 1 else 2)
    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(60):
            fps.add(at)
            near = at
            for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 5, 8))):
                near ^= 1 << b
            at = near if rng.random() < 0.5 else at
            fps.add(near)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    label = brute_components(fps)
    for a in range(len(fps)):
        for b in range(a):
            same = got.get(signed[a], signed[a]) == got.get(signed[b], signed[b])
            assert same == (label[a] == label[b])


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(5, 5), (None, 3), (1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert {got[k] for k in range(301)} == {0} and got[1001] == got[1000] == 1000


def test_mixing(spark, odd):
    rows = odd + [(100 + k, "w " * (k % 17), f"s{k % 5}") for k in range(400)]
    got = mixing.mixture_table(table(spark, rows)).collect()
    size = lambda t: len((t or "").encode().split())
    per = defaultdict(int)
    for _, t, s in rows:
        per[s] += size(t)
    order = sorted((s for s in per if s is not None), key=str) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, free, total = {}, set(per), sum(per.values())
    while free:  # by the rule itself: share, hold those above three times their size, share the rest again
        rest, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / w > 3 * per[s]}
        if not over:
            target |= {s: rest * weight[s] / w for s in free}
            break
        target |= {s: 3 * per[s] for s in over}
        free -= over
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == per[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= 0.5 + 1e-9 for s in per)
    again = mixing.mixture_table(table(spark, rows).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    docs = mixing.mix_documents(table(spark, rows))
    assert docs.columns == table(spark, rows).columns


PASSAGE = ". ".join(" ".join(f"p{s}w{k}" for k in range(9)) for s in range(8)) + "."


def test_substrings(spark):
    clean = ". ".join(" ".join(f"c{s}x{k}" for k in range(7)) for s in range(30)) + "."
    rows = [(1, "Start here now. " + PASSAGE + " The end of one."), (2, "Another begin " + PASSAGE.upper().replace(" ", "\n", 3) + " goes on."), (3, clean), (4, PASSAGE + " " + PASSAGE), (None, PASSAGE), (5, None), (6, ""), (3, clean), (7, "No. No. No. No. No. No."), (7, "x " + PASSAGE + " y")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, run string")
    got = substring_dedup.dedup_substrings(df).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert by[1][0]["n_removed"] == 0 and by[3][0]["text"] == clean and by[3][1]["text"] == clean and by[5][0]["text"] == "" == by[6][0]["text"]
    assert "p4w4" not in by[2][0]["text"].lower() and "p4w4" not in by[4][0]["text"] and "p4w4" not in by[None][0]["text"] and by[2][0]["text"].startswith("Another begin")
    assert all("p4w4" not in r["text"] for r in by[7]) and any(r["text"].startswith("No. No.") for r in by[7])
    r, text = by[2][0], rows[1][1]
    kept, at = "", 0
    for s in r["spans"]:
        kept, at = kept + text[at : s["begin"]], s["end"]
    assert "".join((kept + text[at:]).split()) == "".join(r["text"].split())


def test_substrings_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(docs).collect()}
    seen, want = {}, {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        gone, found = set(), substring_dedup.sentences((r["text"] or "").encode())
        assert sum(x[2] for x in found) == len((r["text"] or "").encode().split())
        for first, length, h in substring_dedup.runs(found):
            if h in seen:
                gone.update(range(first, first + length))
            seen.setdefault(h, r["doc_id"])
        want[r["doc_id"]] = len(gone)
    assert got == want and sum(got.values()) > 0


@pytest.mark.parametrize("work", [exact_dedup.exact_groups, exact_dedup.drop_exact, simhash.near_groups, simhash.drop_near, mixing.mixture_table, mixing.mix_documents, substring_dedup.dedup_substrings])
def test_empty_tables(spark, work):
    assert work(table(spark, [(1, "x", "a")]).limit(0)).count() == 0


def test_runs_start_and_end_at_every_sentence():
    rng = random.Random(4)
    for _ in range(300):
        found = [(0, 0, n, rng.getrandbits(64), n > 16 or rng.random() < 0.4) for n in (rng.choice((1, 2, 4, 9, 15, 22)) for _ in range(rng.randrange(14)))]
        size = lambda k, e: sum(x[2] for x in found[k:e])

        def is_run(k, e):
            part = found[k:e]
            return size(k, e) >= 20 and (len(part) != 2 or all(x[4] for x in part) or max(x[2] for x in part) >= 20)

        n = len(found)
        want = {(k, next((e for e in range(k + 1, n + 1) if is_run(k, e)), None)) for k in range(n)}
        want |= {(next((k for k in reversed(range(e)) if is_run(k, e)), None), e) for e in range(1, n + 1)}
        assert sorted((k, e - k) for k, e in want if k is not None and e is not None) == [(k, length) for k, length, _ in substring_dedup.runs(found)]


def test_repeats_go_to_their_last_sentence(spark):
    passage = "The first of three has nine words in it. The second one has as many words in it. The third makes it long enough to count. A tail stays. Never."
    plain = " ".join(f"word{k}" for k in range(55))
    rows = [(1, f"Alpha begins. {passage} Beta ends here."), (2, f"Gamma is new. {passage} Delta is last."), (3, f"some more {plain} and others"), (4, f"quite different {plain} at its end")]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == "Gamma is new. Delta is last." and got[1] == rows[0][1] and "word40" not in got[4]


def test_files_between_rounds_follow_the_number_of_edges(spark, monkeypatch):
    made, store = [], components.store

    def kept(df, name, **more):
        made.append((name, store(df, name, **more)))
        return made[-1][1]

    monkeypatch.setattr(components, "store", kept)
    most = 2 * spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(5 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(40 * most).select((F.col("id") * 2).alias("a"), (F.col("id") * 2 + 1).alias("b"))
        got = components.components(edges).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["node"]: r["root"] for r in got} == {k: k - k % 2 for k in range(80 * most)}
    assert max(len(df.inputFiles()) for name, df in made if name != "star_edges") <= most
