"""Exact, SimHash and suffix-array dedup against brute force."""

import random
from collections import defaultdict

import pytest

from barloom.llm import exact_dedup, simhash_dedup, suffix_dedup
from barloom.llm.common import components

SCHEMA = "doc_id long, text string"


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


# ---- components


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    random.seed(seed)
    links = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    parent = {n: n for e in links for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = rows(components(spark.createDataFrame(links, "a long, b long")), "node", "root")
    assert got == sorted(((n, root(n)) for n in parent), key=str)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- exact

TEXTS = [
    (5, "a b"), (3, "a \t\n b"), (9, "a b"), (1, "a b c"), (4, None), (2, ""), (None, "a b"), (7, " "), (8, " "),
    (3, "a  b"), (6, "x" * 500), (10, "x" * 499 + "y"), (11, "x" * 500), (None, "only null"), (None, "only null"),
]


@pytest.mark.parametrize("one_id", [7, None])
def test_rows_under_one_id_are_dealt_once(spark, one_id):
    n = 20_000
    rows = [(one_id, "")] * n + [(one_id, "a  b"), (one_id, "a b"), (one_id, "single")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    report = exact_dedup.copy_report(df).collect()
    assert sum(r["kept"] for r in report) == 3 and {r["group_size"] for r in report} == {n, 2, 1}
    assert exact_dedup.drop_copies(df).count() == 3
    members = df.filter("text = ''").selectExpr(
        "doc_id AS _id", "text AS _text", "1L AS _key", "1L AS h1", "1L AS h2", "0L AS n_bytes", "'' AS digest",
        f"{one_id or 'cast(NULL as bigint)'} AS keep_id", f"{n}L AS size", "monotonically_increasing_id() AS _n",
    )
    dealt = exact_dedup._dealt(exact_dedup.stage(members, "members")).groupBy("share").count().collect()
    shares = -(-n // 1_000)
    assert len(dealt) == shares and sum(r["count"] for r in dealt) == n + shares and max(r["count"] for r in dealt) < 1_300


def brute_copies(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[exact_dedup.normalised(t or "")].append(i)
    return sorted((
        (i, smallest(groups[exact_dedup.normalised(t or "")]), len(groups[exact_dedup.normalised(t or "")])) for i, t in docs
    ), key=str)


@pytest.mark.parametrize("primes, huge", [(exact_dedup.PRIMES, exact_dedup.HUGE), ((3, 5), exact_dedup.HUGE), (exact_dedup.PRIMES, 10), ((3, 5), 10)])
def test_copies_also_under_collisions_and_by_chunks(spark, primes, huge):
    report = exact_dedup.copy_report(spark.createDataFrame(TEXTS, SCHEMA), primes=primes, huge=huge)
    assert rows(report, "doc_id", "keep_id", "group_size") == brute_copies(TEXTS)
    kept = [r for r in report.collect() if r["kept"]]
    assert len(kept) == len({exact_dedup.normalised(t or "") for _, t in TEXTS})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len({r["text_sha256"] for r in report.collect()}) == len(kept)


def test_hash_composes():
    poly = exact_dedup.Polynomial()
    data = random.Random(1).randbytes(300_000)
    parts = [data[:70_000], data[70_000:70_001], data[70_001:]]
    total = [0, 0]
    behind = len(data)
    for part in parts:
        behind -= len(part)
        total = [(t + s) % p for t, s, p in zip(total, poly.shifted(poly.hash(part), behind), poly.primes)]
    assert total == poly.hash(data)
    assert poly.hash(b"\0") != poly.hash(b"\0\0") != poly.hash(b"")


def test_large_group_is_shared_out(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARE_TEXTS", 2)
    monkeypatch.setattr(exact_dedup, "SHARE_BYTES", 1)
    docs = [(i, "same words") for i in range(50)] + [(0, "same words"), (99, "other")]
    report = exact_dedup.copy_report(spark.createDataFrame(docs, SCHEMA))
    assert rows(report, "doc_id", "keep_id", "group_size") == brute_copies(docs)
    assert report.filter("kept").count() == 2


def test_dropping_keeps_columns_and_one_row_each(spark):
    docs = [(i, t, "x", 1, 2) for i, t in TEXTS]
    df = spark.createDataFrame(docs, "doc_id long, text string, keep_id string, _id long, _row long")
    left = exact_dedup.drop_copies(df)
    assert left.schema == df.schema
    assert len(left.collect()) == len({exact_dedup.normalised(t or "") for _, t in TEXTS})
    assert {r["doc_id"] for r in left.filter("text like 'a%b'").collect()} == {3}


# ---- SimHash


def brute_groups(docs, distance=3):
    prints = [simhash_dedup.fingerprint_of(t or "") for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = defaultdict(list)
    for g, (i, _) in zip(group, docs):
        ids[g].append(i)
    return prints, sorted(((i, smallest(ids[g])) for g, (i, _) in zip(group, docs)), key=str)


def near_texts(seed):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(4))
    docs = [(None, None), (40, ""), (41, " \n"), (42, "one"), (43, "one two"), (44, "ONE TWO"), (45, "é É")]
    for i in range(25):
        words = [word() for _ in range(200)]
        docs.append((i, " ".join(words)))
        for j in range(random.randrange(4)):
            words[random.randrange(200)] = word()
            docs.append((100 * (j + 1) + i, " ".join(words)))
    return docs + docs[10:12]


@pytest.mark.parametrize("list_rows", [2_000, 1])
def test_near_groups(spark, list_rows):
    docs = near_texts(3)
    prints, want = brute_groups(docs)
    got = simhash_dedup.near_groups(spark.createDataFrame(docs, SCHEMA), list_rows=list_rows)
    assert rows(got, "doc_id", "component_id") == want
    assert sorted(r["fp"] & (2**64 - 1) for r in got.collect()) == sorted(prints)


@pytest.mark.parametrize("list_rows", [2_000, 1])
def test_links_connect_what_is_within_three_bits(spark, list_rows):
    random.seed(5)
    base = random.getrandbits(64)
    prints = {base} | {base ^ 1 << a ^ 1 << b for a in range(12) for b in range(12)}
    for _ in range(120):
        flipped = random.choice(sorted(prints))
        for bit in random.sample(range(64), random.randrange(1, 6)):
            flipped ^= 1 << bit
        prints.add(flipped)
    signed = sorted(p - 2**64 if p >> 63 else p for p in prints)
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    found = simhash_dedup.links(spark.createDataFrame([(p,) for p in signed], "fp long"), list_rows=list_rows).distinct()
    got = {(r["a"], r["b"]) for r in found.collect()}
    assert got <= near and len(got) < len(near)
    around = {p: {p} for p in signed}
    for a, b in got:
        around[a].add(b)
        around[b].add(a)
    assert all(around[a] & around[b] for a, b in near)


def test_fingerprint_is_spark_xxhash(spark):
    value = spark.sql("SELECT xxhash64('one two three') AS h").first()["h"]
    assert simhash_dedup.fingerprint_of("One  TWO\nthree") == value & (2**64 - 1)


def test_one_document_of_each_group_stays(spark):
    docs = near_texts(4)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], SCHEMA + ", fp int")
    _, groups = brute_groups(docs)
    left = simhash_dedup.drop_near_copies(df)
    assert left.schema == df.schema
    assert {r["doc_id"] for r in left.collect()} == {g for _, g in groups}


# ---- suffix array


def brute_spans(docs, size):
    places = defaultdict(list)
    for n, (_, t) in enumerate(docs):
        words = (t or "").split()
        for j in range(len(words) - size + 1):
            places[tuple(words[j:j + size])].append(n)
    out = []
    for i, t in docs:
        words = (t or "").split()
        spans = []
        for j in range(len(words) - size + 1):
            held = places[tuple(words[j:j + size])]
            if len(held) < 2:
                continue
            first = smallest(docs[n][0] for n in held)
            if spans and j <= spans[-1][1]:
                spans[-1] = (spans[-1][0], j + size, smallest([spans[-1][2], first]))
            else:
                spans.append((j, j + size, first))
        out += [(i, *s) for s in spans]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, size, k", [(0, 6, 3), (1, 9, 4), (2, 5, 5), (3, 4, 1)])
def test_repeated_spans(spark, monkeypatch, seed, size, k):
    random.seed(seed)
    if seed % 2:
        monkeypatch.setattr(suffix_dedup, "STRETCH", 10)
    letters = "abcdef"[: 2 + seed]
    docs = [(random.choice([i, i, None, 3]), " ".join(random.choice(letters) for _ in range(random.choice([0, 3, 12, 40])))) for i in range(30)]
    for n in range(10):
        whole = random.choice(docs)[1]
        docs.append((100 + n, whole if n % 2 else " ".join(whole.split()[2:20]) + " z " + random.choice(docs)[1]))
    docs.append((999, None))
    got = suffix_dedup.repeated_spans(spark.createDataFrame(docs, SCHEMA), min_words=size, k=k)
    assert rows(got, "doc_id", "start_word", "stop_word", "first_id") == brute_spans(docs, size)


# ---- all three


@pytest.mark.parametrize("run", [exact_dedup.copy_report, exact_dedup.drop_copies, simhash_dedup.near_groups, simhash_dedup.drop_near_copies, suffix_dedup.repeated_spans])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text(spark):
    long = " ".join(f"w{i % 9973}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, long)], SCHEMA)
    assert rows(exact_dedup.copy_report(docs, huge=1 << 16), "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 1)]
    assert rows(simhash_dedup.near_groups(docs), "doc_id", "component_id") == [(1, 1), (2, 1), (3, 1)]
    assert rows(suffix_dedup.repeated_spans(docs), "doc_id", "start_word", "stop_word") == [(i, 0, 300_000) if i != 2 else (2, 0, 300_000) for i in (1, 2, 3)]
