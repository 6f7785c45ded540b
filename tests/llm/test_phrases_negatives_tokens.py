"""Collocations, hard negatives and byte-level BPE against brute force and the library."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from cardflow.llm import byte_bpe, collocations, hard_negatives, language_id, mixing, quality_rules, queries
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LONG = "word stream " * 20_000


# -- byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_rank_queue_gives_the_lowest_rank_and_leftmost_position():
    rng = random.Random(2)
    queue, held = byte_bpe.RankQueue(70_000), []
    for _ in range(3000):
        if held and rng.random() < 0.45:
            rank, position = min(held)
            assert queue.first() == rank and queue.pop(rank) == position
            held.remove((rank, position))
        else:
            held.append((rng.choice([rng.randrange(70_000), rng.randrange(100), 69_999]), rng.randrange(500)))
            queue.push(*held[-1])
    for rank, position in sorted(held):
        assert queue.first() == rank and queue.pop(rank) == position
    assert queue.first() == -1 and not any(any(level) for level in queue.levels)


def test_ids_equal_the_librarys(vocabulary, library):
    rng = random.Random(7)
    alphabets = ["ab", "abc ", "aeiou nst", "日本語テスト", "0123456789", "é́‍ ñ", "\n \t\x0b\x1c\x85\xa0x'S'll", "🙂👍🏽 a"]
    texts = ["", "'s 'LL don't  \n\n x", "<|endoftext|>", "a" * 5000, "ab" * 3000 + "ba" * 3000]
    texts += ["".join(rng.choices(rng.choice(alphabets), k=rng.choice([1, 5, 40, 700]))) for _ in range(600)]
    got = vocabulary.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [vocabulary.decode(ids).decode() for ids in got] == texts


def test_pieces_alone_and_together_are_the_same(vocabulary, library):
    rng = random.Random(8)
    pieces = [bytes(rng.choices(b"abcdefgh \xc3\xa9", k=rng.randrange(1, 150))) for _ in range(400)] + [b"aaa", b"a" * 120]
    want = [library._core_bpe.encode_single_piece(p) for p in pieces]
    assert [vocabulary.merge(p) for p in pieces] == vocabulary.merge_many(pieces) == want
    assert vocabulary.merge_many([]) == []


def test_forgetting_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 1000)
    monkeypatch.setattr(byte_bpe, "TOGETHER", 50)
    texts = [f"many different words {k} and xyzzy{k * 7}" for k in range(200)]
    assert [vocabulary.encode([t])[0] for t in texts] == [library.encode_ordinary(t) for t in texts]


def test_byte_bpe_documents(spark, library):
    texts = [None, "", " ", "é日🙂\x00z", "same", "same", "x\n\ny  z ", LONG, "q" * 3000]
    rows = [(n if n else None, t, 1) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = byte_bpe.encode_documents(docs, RANKS, PATTERN)
    assert [(r.doc_id, r.decoded, r.ids, r.n_tokens) for r in found.collect()] == [
        (d, t or "", ids, len(ids)) for (d, t, _) in rows for ids in [library.encode_ordinary(t or "")]
    ]
    for r, (_, t, _) in zip(byte_bpe.encode_documents(docs, RANKS, PATTERN, digests=True).collect(), rows, strict=True):
        ids = " ".join(map(str, library.encode_ordinary(t or "")))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, PATTERN, digests=True).count() == 0


def test_a_vocabulary_without_all_bytes_is_refused(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary(str(tmp_path / "ranks"), PATTERN)


# -- collocations


def brute_collocations(rows, longest, least, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            score, _, l, r = min(
                (1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            inside = any(
                len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def made_texts(rng, n):
    words = ["the", "of", "And", "é", "日本", "x1", "RARE", "ß", "İ", "a b", "new", "york"]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            parts.append(rng.choice(words) if rng.random() < 0.9 else f"only{k}")
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0c", " new york city ", "\x1f"]))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", "zh tw"]), "".join(parts)))
    return [*rows, (None, None), ("en", ""), ("en", " .,; "), ("xx", "alone")]


@pytest.mark.parametrize("longest,least,top", [(3, 10, 2000), (3, 3, 7), (2, 4, 2000), (4, 3, 2000)])
def test_collocations_by_brute_force(spark, longest, least, top):
    rows = made_texts(random.Random(longest * 100 + least), 150)
    docs = spark.createDataFrame([(l, t, 1, "x") for l, t in rows], "lang string, text string, n int, first string")
    found = collocations.mine(docs, longest, least, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, longest, least, top)


def test_common_beginnings_change_no_result(spark, monkeypatch):
    """Every first word and pair dealt over several places, and few words counted together."""
    rows = made_texts(random.Random(9), 120)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for name, value in (("COMMON", 10**9), ("LEAST", 1), ("PLACES", 3), ("WORDS_TOGETHER", 50), ("BYTES_TOGETHER", 1500)):
        monkeypatch.setattr(collocations, name, value)
    assert len(collocations.common_beginnings(docs, 3)) > 50
    assert sorted(map(tuple, collocations.mine(docs, 3, 5, 2000).collect())) == brute_collocations(rows, 3, 5, 2000)


def test_bundles_too_large_for_a_task_are_added_up_in_parts(spark, monkeypatch):
    rows = made_texts(random.Random(10), 150)
    docs = spark.createDataFrame(rows, "lang string, text string")
    for name, value in (("WORDS_TOGETHER", 40), ("BYTES_TOGETHER", 300), ("BATCH_ROWS", "20"), ("COMMON", 1)):
        monkeypatch.setattr(collocations, name, value)
    bundled = collocations.counted_windows(docs, 3)
    firsts = [r["first"] for r in bundled.collect()]
    assert max(Counter(firsts).values()) > 40
    assert sorted(map(tuple, collocations.mine(docs, 3, 5, 2000).collect())) == brute_collocations(rows, 3, 5, 2000)


def test_collocations_read_one_shuffle_and_empty_tables(spark, plan_of):
    docs = spark.createDataFrame(made_texts(random.Random(1), 20), "lang string, text string")
    plan = plan_of(collocations.phrase_counts(docs), run=True).split("Initial Plan")[0]
    # The texts are read once: windows are made by one map and added up by another.
    assert plan.count("MapInArrow") == 2 and "Expand" in plan
    assert collocations.mine(docs.limit(0)).count() == 0
    assert collocations.mine(spark.createDataFrame([("en", "a b " * 30_000)], "lang string, text string")).count() == 2


# -- hard negatives


def brute_negatives(rows, width):
    """rows: (id, label, vector) of those that take part."""
    vectors = [np.pad(np.floor(256 * np.array(v, float)), (0, width - len(v))).astype(np.int64) for *_, v in rows]
    out = []
    for at, (anchor, label, _) in enumerate(rows):
        if anchor % 100:
            continue
        like = [int(vectors[at] @ v) for v in vectors]
        same = sorted((-like[k], r[0]) for k, r in enumerate(rows) if r[1] == label and k != at)[:5]
        for score, positive in same:
            fit = sorted(
                (-like[k], r[0]) for k, r in enumerate(rows) if r[1] != label and -30 * score <= 100 * like[k] <= -90 * score
            )
            out += [(anchor, positive, n, i, -score, -s) for n, (s, i) in enumerate(fit[:10], 1)]
    return sorted(out)


def made_vectors(rng, n, width):
    rows = []
    for k in range(n):
        base = rng.normal(size=width) + 1.5 * (k % 4 == 0)
        vector = [float(np.float32(x)) for x in (base if k % 5 else np.ones(width))]
        rows.append([k, int(rng.integers(0, 4)), vector[: width - (k % 11 == 0)]])
    return rows


def test_hard_negatives_by_brute_force(spark, monkeypatch):
    for name, value in (("SAMPLE_ROWS", 200), ("FANOUT", 4), ("LEAF_SAMPLE", 8), ("LEAST_BLOCK", 100), ("CELLS", 3000)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = made_vectors(np.random.default_rng(4), 1200, 6)
    bad = [(None, 1, [1.0]), (100, None, [1.0]), (200, 1, None), (300, 1, [math.nan]), (5, 1, [1.0, None]), (7, 2, [math.inf])]
    table = spark.createDataFrame(
        [(*r, "x", 0) for r in [*map(tuple, rows), *bad]], "vec_id long, label int, embedding array<float>, vec string, block int"
    ).repartition(7)
    got = hard_negatives.mine(table, F.col("id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 6)


def test_hard_negatives_of_repeated_ids_and_vectors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_BLOCK", 20)
    rows = [[100, 1, [1.0, 0.0]]] * 3 + [[k, k % 3, [0.5, 0.0]] for k in range(1, 90)] + [[200, 9, [1.0, 1.0]], [300, 1, [0.0, 0.0]]]
    rows += [[400, 5, []], [401, 5, [-1.0]]]
    table = spark.createDataFrame([tuple(r) for r in rows], "vec_id long, label int, embedding array<double>")
    got = sorted(map(tuple, hard_negatives.mine(table, F.col("id") % 100 == 0).collect()))
    assert got == brute_negatives(rows, 2)
    assert hard_negatives.mine(table.limit(0), F.col("id") % 100 == 0).count() == 0
    assert hard_negatives.mine(table.limit(1), F.col("id") % 100 == 0).count() == 0


def test_tree_leaves_out_only_what_can_not_fit():
    rng = np.random.default_rng(6)
    rows = np.floor(50 * rng.normal(size=(3000, 3)) + 300 * rng.integers(0, 3, size=(3000, 1)))
    tree = hard_negatives.Tree(rows[:500])
    leaf = tree.leaf_of(rows)
    ranges = defaultdict(lambda: [math.inf, -math.inf])
    for at, which, child, distance in tree.paths(rows):
        for row, j in zip(which, child, strict=True):
            spans = [((at, -1, j), float(rows[row] @ rows[row]))]
            spans += [((at, i, j), float(((rows[row] - p) ** 2).sum())) for i, p in enumerate(tree.nodes[at].points)]
            for key, value in spans:
                ranges[key] = [min(ranges[key][0], value), max(ranges[key][1], value)]
    tree.set_ranges([(*key, *span) for key, span in ranges.items()])
    anchors = rows[::100]
    best = (anchors @ rows.T).max(1)
    least, most = 0.9 * best, best
    found = tree.survivors(anchors, least, most)
    assert 0 < found.mean() < 0.8
    for k, a in enumerate(anchors):
        like = rows @ a
        assert found[k][leaf[(like >= least[k]) & (like <= most[k])]].all()


def test_scores_are_exact_or_refused():
    a = np.array([[2.0**30, 1.0]])
    assert hard_negatives.scores(a, a).tolist() == [[2**60 + 1]]
    with pytest.raises(OverflowError):
        hard_negatives.scores(a * 2**5, a)


# -- other contracts


def test_held_out_is_never_null(spark):
    ids = spark.createDataFrame([(None,), (1,), (7,)], "doc_id long")
    assert {r[0] for r in ids.select(queries.held_out(5, 0)).collect()} <= {True, False}


def test_language_of_numbers_and_repeated_ids(spark):
    """A language whose rows share an id is learned; numerals are no letters."""
    rows = [(k, "the quick brown fox and the dog " * 3, "en") for k in range(300)]
    rows += [(5, f"der schnelle braune fuchs und ein hund {'x' * (k % 30)}", "de") for k in range(600)]
    rows += [(9, "le renard brun et le chien", "fr")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    asked = spark.createDataFrame([(1, "²²² Ⅷ"), (2, "der fuchs und ein hund"), (4, "the dog")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language_id.identify(asked, model).collect()}
    assert found == {1: "und", 2: "de", 4: "en"} and model.languages == ["de", "en", "fr"]


def test_mixed_documents_with_clashing_columns(spark):
    names = ["_size", "_taken", "_rest", "_mix_rounds", "size", "first"]
    rows = [(k, f"word{k} " * 30, "ab"[k % 2], *range(6)) for k in range(40)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    out = mixing.mixed_documents(docs, ("doc_id",))
    assert out.columns == docs.columns and out.count() > 0


def test_ratio_and_verdict_by_plain_loops(spark):
    rng = random.Random(12)
    words = [f"Word{k}" for k in range(60)] + ["é", "x#y"]
    texts = {d: " ".join(rng.choices(words[:30] if d % 3 else words[20:], k=rng.randrange(1, 90))) for d in range(160)}
    texts |= {160: "", 161: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d % 3 > 0), 0) for d in range(0, 200, 2)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")

    def grams(text):
        low = [w.lower() for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        one = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in low]
        two = [xxhash.xxh64(b.encode(), seed=one[k]).intdigest() for k, b in enumerate(low[1:])]
        return [h % quality_rules.BUCKETS for h in one + two]

    raw, good = Counter(), Counter()
    for d, t in texts.items():
        raw.update(grams(t))
        if d % 2 == 0 and d % 3:
            good.update(grams(t))
    share = lambda counts, b: (counts[b] + 1) / (sum(counts.values()) + quality_rules.BUCKETS)
    ratio = {}
    for d, t in texts.items():
        each = [math.log(share(good, b) / share(raw, b)) for b in grams(t)]
        ratio[d] = sum(each) / max(1, len(each))
    found = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    passed = sorted(ratio[d] for d in texts if d % 2 == 0 and d % 3 and not found[d].base_failed)
    least = passed[max(1, math.ceil(len(passed) * quality_rules.TRUSTED_LOSS)) - 1]
    for d in texts:
        assert found[d].ratio == pytest.approx(ratio[d], abs=1e-12)
        assert found[d].kept == (not found[d].base_failed and ratio[d] >= least - 1e-12)


def test_leader_by_plain_loops():
    """Follow-the-regularised-leader over dictionaries, one weight at a time."""
    rng = random.Random(13)
    k, last = 3, language_id.BUCKETS
    rows = [([*sorted(rng.sample(range(40), 6))], [rng.randrange(1, 5) for _ in range(6)], rng.randrange(k)) for _ in range(15)]
    idf = np.ones(language_id.BUCKETS)
    idf[:40] = [1 + rng.random() for _ in range(40)]
    z, n = defaultdict(float), defaultdict(float)

    def weight(b, y):
        l1 = 0.0 if b == last else language_id.L1
        if abs(z[b, y]) <= l1:
            return 0.0
        return -(z[b, y] - math.copysign(l1, z[b, y])) / (
            (language_id.BETA + math.sqrt(n[b, y])) / language_id.ALPHA + language_id.L2
        )

    for _ in range(language_id.EPOCHS):
        for buckets, counts, truth in rows:
            x = [(1 + math.log(c)) * idf[b] for b, c in zip(buckets, counts, strict=True)]
            norm = math.sqrt(sum(v * v for v in x))
            at = [*zip(buckets, [v / norm for v in x], strict=True), (last, 1.0)]
            w = {(b, y): weight(b, y) for b, _ in at for y in range(k)}
            logits = [sum(v * w[b, y] for b, v in at) for y in range(k)]
            total = sum(math.exp(v) for v in logits)
            for y in range(k):
                error = math.exp(logits[y]) / total - (y == truth)
                for b, v in at:
                    g = v * error
                    z[b, y] += g - (math.sqrt(n[b, y] + g * g) - math.sqrt(n[b, y])) / language_id.ALPHA * w[b, y]
                    n[b, y] += g * g
    model = language_id.train([(np.array(b), np.array(c), y) for b, c, y in rows], ["a", "b", "c"], idf)
    assert model.temperature == 1.0
    dense = np.zeros((language_id.BUCKETS + 1, k))
    dense[model.rows], dense[last] = model.weights[:-1], model.weights[-1]
    for b in [*range(40), last]:
        assert dense[b] == pytest.approx([weight(b, y) for y in range(k)], abs=1e-9)
