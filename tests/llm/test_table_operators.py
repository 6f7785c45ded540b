"""URL filter, mixing, near and exact dedup, pipeline: brute force and edge cases."""

import hashlib
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from cardflow.llm import exact_dedup, mixing, near_dedup, queries, url_filter
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_bloom_cascade_is_exact():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    for share in (0.0, 0.01, 0.5, 1.0):
        listed = rng.random(len(keys)) < share
        levels = url_filter.build(keys[listed], keys[~listed])
        levels = url_filter.unpack(url_filter.pack(levels))
        assert (url_filter.member(levels, keys) == listed).all()


URLS = [
    ("https://Example.org/es/1?x", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://notexample.com/de/#a", "notexample.com", "/de/", "com/de/", "block"),
    ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("http://É.NET/Ä?b://c", "É.net", "/Ä", None, "allow"),
    ("http://spam.net/p", "spam.net", "/p", None, "block"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.mark.parametrize("bound", [url_filter.BROADCAST_BYTES, -1])
def test_url_rules_and_edges(spark, monkeypatch, bound):
    """Both ways to the cascades, below and beyond the bound of the broadcast."""
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", bound)
    rows = [(n, u[0], "w", True) for n, u in enumerate(URLS)] + [(0, URLS[0][0], "w", True)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, listed boolean")
    found = url_filter.judge(pages, url_filter.host_of(F.col("url")).rlike("^spam")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[r.page_id][1:]
    assert url_filter.judge(pages.limit(0), F.lit(True)).count() == 0


def seats_by_quotient(votes: list[int], seats: int) -> list[int]:
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(7)
    for _ in range(6):
        votes = [rng.choice([0, 1, 3, rng.randrange(1, 2000)]) for _ in range(rng.randrange(1, 12))] + [5]
        seats = rng.choice([0, 1, 7, 100, 1000])
        rows = spark.createDataFrame([(n, v, seats) for n, v in enumerate(votes)], "party long, votes long, seats long")
        found = mixing.apportion(rows, [], "party", "votes", "seats").collect()
        assert [r.won for r in sorted(found, key=lambda r: r.party)] == seats_by_quotient(votes, seats)


def brute_targets(sizes: dict) -> dict:
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-6 and free:
        total, share, left = sum(weight[s] for s in free), left, 0.0
        for s in sorted(free, key=str):
            target[s] += share * weight[s] / total
        for s in [s for s in free if target[s] >= 3 * sizes[s]]:
            left += target[s] - 3 * sizes[s]
            target[s] = 3.0 * sizes[s]
            free.discard(s)
    return target


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    rng = random.Random(9)
    rows = []
    for n in range(600):
        source = rng.choices(["big", "b", "tiny", "", None, "é"], [60, 10, 1, 10, 10, 5])[0]
        rows.append((n, rng.choice([None, "", "one", " ".join(["w"] * rng.randrange(80))]), source, 1))
    rows += [(7, "same id twice", "b", 1), (None, "no id", "b", 1), (None, "no id", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int").coalesce(3)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes, taken, targets = Counter(), Counter(), {}
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    of = dict((r[0], r[2]) for r in rows if r[0] not in (7, None))
    for r in found:
        source = of.get(r.doc_id, "b") if r.doc_id != 7 else None
        assert 0 <= r.taken <= 3 * r["size"]
        if r.doc_id not in (7,):
            assert r.source_size == sizes[source]
            targets[source] = r.target
            taken[source] += r.taken
    expected = brute_targets(sizes)
    for source, target in targets.items():
        assert abs(target - expected[source]) < 1e-6 * max(1, expected[source])
        assert abs(taken[source] - target) <= 3 * 80 + 0.02 * target
    again = {(r.doc_id, r["size"], r.taken) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r["size"], r.taken) for r in found}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(docs.filter("text = ''")).collect()} == {0}


def test_mixed_documents_have_the_words_taken(spark):
    rows = [(n, " ".join(f"w{n}_{k}" for k in range(5 + n % 60)), f"s{n % 4}", 0) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, ("doc_id",)).collect()}
    words = Counter()
    for r in mixing.mixed_documents(docs, ("doc_id",)).collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({d: t for d, t in taken.items() if t})


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, weak):
    """With a weak digest, different texts share digests and the bytes must decide."""
    rng = random.Random(10)
    texts = [None, "", "A", "a", "É", "é", "AB", "ba", "x" * 50_000, "X" * 50_000]
    rows = [(n, rng.choice(texts), "k", "d") for n in range(120)] + [(None, "only null id", "k", "d"), (None, "a", "k", "d")]
    rows += [rows[-3], rows[-3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, digest string")
    digest = (lambda t: F.length(t).cast("string").cast("binary")) if weak else exact_dedup.sha256
    found = exact_dedup.resolve(docs, digest).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for d, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(d)
    expected = Counter()
    for ids in groups.values():
        keep = max((d for d in ids if d is not None), default=None)
        expected.update((d, keep, len(ids)) for d in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == expected
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert exact_dedup.resolve(docs.limit(0)).count() == 0
    if not weak:
        left = exact_dedup.drop_copies(docs)
        assert left.columns == docs.columns
        assert sorted((r.text or "").translate(LOWER) for r in left.collect()) == sorted(groups)


def brute_components(rows):
    sets, parent = {}, {}
    for d, text in rows:
        w = (text or "").translate(LOWER).encode().split()
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        parent[d] = d

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_dedup_by_brute_force(spark):
    rng = random.Random(11)
    rows, base = [], [f"w{rng.randrange(4000)}" for _ in range(100)]
    for n in range(260):
        kind = rng.randrange(5)
        if kind == 0:
            words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(1, 60))]
        elif kind == 1:  # a chain of copies, each a little different from the one before
            words = rows[-1][1].split() if rows and rows[-1][1] else ["a"]
            words = words[:-1] + [f"n{n}"]
        elif kind == 2:
            words = rng.choice([[], ["few", "words"], ["Few", "Words"]])
        else:  # copies of one text with up to a third of the shingles changed
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(100)] = f"x{n}_{rng.randrange(99)}"
        rows.append((n, " ".join(words)))
    rows[5] = (5, None)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int")
    found = {r.doc_id: r for r in near_dedup.label(docs).collect()}
    for d, (size, root) in brute_components(rows).items():
        assert (found[d].n_shingles, found[d].component_id, found[d].kept) == (size, root, d == root)


def test_near_dedup_edges(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (3, text), (3, text), (None, "nobody else has this text at all"), (4, ""), (5, None), (6, "x " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.label(docs).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        {(None, 3, False): 1, (3, 3, True): 2, (None, None, True): 1, (4, 4, True): 1, (5, 5, True): 1, (6, 6, True): 1}
    )
    assert near_dedup.label(docs.limit(0)).count() == 0
    stay = near_dedup.drop_near_copies(docs).collect()
    assert Counter(r.doc_id for r in stay) == Counter({3: 1, None: 1, 4: 1, 5: 1, 6: 1})
    assert near_dedup.drop_near_copies(docs.limit(0)).count() == 0


def test_near_copies_of_repeated_ids(spark):
    """An id with two texts stands in two components, and each keeps one row."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(1, a), (2, a + " more"), (2, b), (3, b + " more"), (2, b), (None, a), (None, "c d e f g h"), (None, "c d e f g h")]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, at_file string, root int")
    found = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.label(docs).collect())
    assert found == Counter({(1, 1, True): 1, (2, 1, False): 1, (2, 2, True): 2, (3, 2, False): 1, (None, 1, False): 1, (None, None, True): 2})
    stay = near_dedup.drop_near_copies(docs)
    assert stay.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in stay.collect()) == Counter({(1, a): 1, (2, b): 1, (None, "c d e f g h"): 1})


def test_near_dedup_of_one_large_group(spark, monkeypatch):
    """A group whose members are mostly no links of its pivot, over several blocks and chunks."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for n in range(300):
        words = list(base)
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(80)] = f"x{n}_{rng.randrange(99)}"
        rows.append((n, " ".join(words)))
    monkeypatch.setattr(near_dedup, "HELD", 2000)
    monkeypatch.setattr(near_dedup, "STREAMED", 5000)
    found = {r.doc_id: r for r in near_dedup.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, (size, root) in brute_components(rows).items():
        assert (found[d].n_shingles, found[d].component_id) == (size, root)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = near_dedup.signature(x[:1200], 2048), near_dedup.signature(x[300:], 2048)
    assert abs((a == b).mean() - 900 / 1500) < 0.05


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = "ab\tcd ef" * 50 + " x"
    whole = near_dedup.WordHasher()(text)
    monkeypatch.setattr(near_dedup, "SEGMENT", 7)
    assert (near_dedup.WordHasher()(text) == whole).all()
    assert len(set(whole.tolist())) == len(set(text.split()))


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = queries.table(spark, SMALL, "documents")
    columns = docs.columns
    scored = {r.doc_id: r.score for r in queries.op10_quality_classifier(spark, SMALL).collect()}
    kept = corpus_pipeline.keep_quality(spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == {d for d, s in scored.items() if s >= 0.3}
    assert kept.columns == columns
    alone = corpus_pipeline.drop_copies(spark, docs, SMALL)
    assert {r.doc_id for r in alone.collect()} == {r.doc_id for r in queries.op9_exact_dedup(spark, SMALL).collect() if r.kept}
    near = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert {r.doc_id for r in near.collect()} == {r.doc_id for r in queries.op7_near_dedup(spark, SMALL).collect() if r.kept}
    mixed = corpus_pipeline.mix_sources(spark, docs, SMALL)
    taken = {r.doc_id: r.taken for r in queries.op6_mixing(spark, SMALL).collect() if r.taken}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == Counter(taken)
    assert alone.columns == near.columns == mixed.columns == columns
    last = corpus_pipeline.run(spark, SMALL).collect()
    assert last and {r.doc_id for r in last} <= set(scored)


def test_op9_hash_of_text(spark):
    rows = {r.doc_id: r for r in queries.op9_exact_dedup(spark, SMALL).collect()}
    for r in queries.table(spark, SMALL, "documents").collect():
        assert rows[r.doc_id].text_sha256 == hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest()
