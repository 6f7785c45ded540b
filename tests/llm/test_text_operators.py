"""Secret scan, sentencepiece, token counts, language, quality: brute force and edge cases."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import math
import random
import urllib.parse
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from cardflow.llm import language_id, quality_rules, quality_zstd, secret_scan, sentencepiece_bpe, token_counts
from pyspark.sql import functions as F

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "word stream " * 20_000
TEXTS = [None, "", " ", "a", "é日🙂\x00z", "Same text here", "Same text here", "x\n\ny  z ", LONG]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, repeats, and columns named like the results."""
    rows = [(n if n else None, t, "src", "en", 0.5, "x") for n, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score double, spans string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


SECRET = "x password=abcdef1234 tail"


@pytest.mark.parametrize(
    "text",
    [
        urllib.parse.quote(SECRET),
        "see " + base64.b64encode(SECRET.encode()).decode() + " end",
        base64.b64encode(gzip.compress(SECRET.encode())).decode(),
        base64.urlsafe_b64encode(urllib.parse.quote(base64.b64encode(SECRET.encode()).decode()).encode()).decode(),
        "".join(f"%{b:02x}" for b in gzip.compress(SECRET.encode())),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
    ],
)
def test_secret_in_nested_layers(text):
    base, spans, unopened = secret_scan.find(text)
    assert not base and unopened == 0
    assert {kind for *_, kind in spans} == {"assign"}
    assert all(0 <= start < end <= len(text) for start, end, _ in spans)


def test_secret_spans_map_exactly():
    text = "é pass%77ord%3Dabcdef12 ok"
    _, spans, _ = secret_scan.find(text)
    assert [text[a:b] for a, b, _ in spans] == ["pass%77ord%3Dabcdef12"]


PACKED = gzip.compress(SECRET.encode() + random.Random(4).randbytes(300).hex(" ").encode(), mtime=0)
CODE = base64.b64encode(b"some text before it, " * 3 + SECRET.encode()).decode()


@pytest.mark.parametrize(
    "text",
    [
        "".join(f"\\x{b:02x}" for b in PACKED),
        "".join(f"\\u{b:04x}" for b in zlib.compress(SECRET.encode())),
        "".join(f"&#{b};" for b in PACKED),
        str(PACKED),
        json.dumps(PACKED.decode("latin-1")),
        *["api/v1/"[n:] + CODE for n in range(4)],
        json.dumps("\n" + CODE),
        "api/v1/" + base64.b64encode(PACKED).decode(),
        base64.encodebytes(PACKED).decode(),
        base64.encodebytes(b"." * 45 + SECRET.encode()).decode(),
        json.dumps(base64.encodebytes(PACKED).decode()),
        base64.b64encode(b"\xff\xfe\x00" * 9 + SECRET.encode()).decode(),
    ],
)
def test_secret_in_escaped_bytes_and_broken_base64(text):
    base, spans, unopened = secret_scan.find(text)
    assert not base and unopened == 0
    assert "assign" in {kind for *_, kind in spans}
    assert all(0 <= start < end <= len(text) for start, end, _ in spans)


def test_secret_spans_in_broken_base64_map_exactly():
    head = b"." * 45
    text = "x/" + base64.encodebytes(head + b"password=abcdef1234").decode()
    _, spans, _ = secret_scan.find(text)
    [(start, end, _)] = spans
    assert (start, end) == (2 + 60, len(text.rstrip("\n=")))


def test_cycles_end():
    looped = secret_scan.Layer("abc", secret_scan.Layer("xyz", secret_scan.Layer("abc"), [(0, 0, 3, 3)]), [(0, 0, 3, 3)])
    assert looped.seen_before()


def test_long_content_is_scanned_in_pieces(monkeypatch):
    monkeypatch.setattr(secret_scan, "PIECE", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 200)
    noise = random.Random(3).randbytes(4000).hex(" ").encode()
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress):
        for at in (500, 990, 9000):
            text = base64.b64encode(pack(noise[:at] + SECRET.encode() + noise[at:])).decode()
            _, spans, unopened = secret_scan.find(text)
            assert unopened == 0 and "assign" in {kind for *_, kind in spans}
    secret_scan.find(base64.b64encode(gzip.compress(b"a" * 100_000)).decode())


@pytest.mark.parametrize("depth", [3, 12])
def test_layers_that_commute_are_visited_once(depth, monkeypatch):
    """URL and escape levels beside each other lead to each text in many ways."""
    url, escaped = "%2525"[:0] + "%" + "25" * depth + "41", "&" + "amp;" * depth + "#66;"
    made = []
    key = secret_scan.Layer.key
    monkeypatch.setattr(secret_scan.Layer, "key", lambda layer: made.append(1) or key(layer))
    secret_scan.find(f"{url} {escaped} and some more words")
    assert len(made) <= 4 * (depth + 2) ** 2


@pytest.mark.parametrize(
    "text",
    [
        "%E9" + "".join(f"%{b:02x}" for b in SECRET.encode()),
        "%20" + "".join(f"%{b:02x}" for b in PACKED),
        "a=%20" + urllib.parse.quote(PACKED),
        "\n".join(CODE[k : k + 12] for k in range(0, len(CODE), 12)),
    ],
)
def test_secret_after_bad_bytes_and_in_short_lines(text):
    base, spans, unopened = secret_scan.find(text)
    assert not base and unopened == 0
    assert "assign" in {kind for *_, kind in spans}
    assert all(0 <= start < end <= len(text) for start, end, _ in spans)


def test_base_spans_by_definition():
    rng = random.Random(5)
    bits = ["password", "=", ":", " ", '"', "AKIA", "ABCDEFGHIJKLMNOPQR", "0f" * 13, "token", "ſecret=abcdef1", "API_KEY", "é", "abc123"]
    for _ in range(500):
        text = "".join(rng.choices(bits, k=12))
        plain = []
        for kind, (pattern, group, least) in secret_scan.KINDS.items():
            plain += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if len(m.group(group)) >= least]
        plain.sort(key=lambda s: (s[0], secret_scan.ORDER[s[2]]))
        base, spans, _ = secret_scan.find(text)
        assert base == plain and set(base) <= set(spans)


def test_secret_edges(docs, nothing):
    found = secret_scan.digests(secret_scan.scan_documents(docs))
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == empty and r.spans == "" and r.n_hex == 0 for r in rows)
    assert secret_scan.digests(secret_scan.scan_documents(nothing)).count() == 0


def test_sentencepiece_equals_library(docs, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = sentencepiece_bpe.encode_documents(docs, MODEL).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for n, text in enumerate(TEXTS):
        expected = library.encode(text or "", add_bos=True, add_eos=True)
        row = by_id[n if n else None]
        assert row.ids == expected and row.decoded == library.decode(expected) and row.n_tokens == len(expected)
    assert sentencepiece_bpe.encode_documents(nothing, MODEL, digests=True).count() == 0


def test_sentencepiece_random():
    words = sentencepiece_bpe.Vocabulary(MODEL)
    rng = random.Random(2)
    alphabet = "abcdeß.,!? \n▁é日0123#  tion ing"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(600)] + ["a" * 500, "<s></s><0x0A>"]
    ids = words.encode(texts)
    assert ids == words.library.encode(texts, add_bos=True, add_eos=True)
    assert [words.decode(x) for x in ids] == words.library.decode(ids)
    for _ in range(600):
        some = [rng.choice([rng.randrange(3), rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(9)]
        assert words.decode(some) == words.library.decode(some)


def test_token_counts_by_encoding_anew():
    counter = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    bits = ["word", " ", "  ", "\n", "it's", "123", "é", "日本", "!?", " x"]
    for _ in range(150):
        text = "".join(rng.choices(bits, k=rng.randrange(0, 900)))
        tree = token_counts.Tree(text, counter)
        for _ in range(6):
            start = rng.randrange(len(text) + 2)
            end = start + rng.choice([0, 0, 1, 5, 200, 5000])
            new = "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 700])))
            tree.edit(start, end, new)
            start, end = min(start, len(text)), max(min(start, len(text)), min(end, len(text)))
            text = text[:start] + new + text[end:]
            assert tree.text == text
            parts = counter.split(text)
            assert tree.total == len(counter.encoding.encode_ordinary(text))
            assert np.concatenate([b[0] for b in tree.blocks]).tolist() == [len(p) for p in parts]


def test_token_count_edits_are_local():
    counter = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    tree = token_counts.Tree(LONG, counter)
    tree.edit(100_000, 100_010, "other words")
    assert 0 < tree.encoded < 60
    assert tree.total == len(counter.encoding.encode_ordinary(tree.text))


def test_token_count_edges(docs, nothing):
    rows = token_counts.count_edits(docs, token_counts.own_edits(), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(TEXTS)
    counter = token_counts.Counter(RANKS, public_tokenizers.PATTERN)
    counts = {n if n else None: len(counter.encoding.encode_ordinary(t or "")) for n, t in enumerate(TEXTS)}
    assert {r.doc_id: r.n_tokens for r in rows} == counts
    assert token_counts.count_edits(nothing, token_counts.own_edits(), RANKS, public_tokenizers.PATTERN).count() == 0


def test_language_held_out(spark):
    rng = random.Random(4)
    syllables = {"xx": ["ka", "to", "ri"], "yy": ["sch", "ein", "gen"], "zz": ["eau", "que", "ment"]}
    rows = []
    for n in range(300):
        lang = rng.choice(list(syllables))
        rows.append((n, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(15)), lang))
    rows += [(300, None, "xx"), (301, "12 34 !", "yy"), (302, "kato kato", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    usable = F.col("doc_id") % 3 != 0
    found = language_id.identify(docs, language_id.fit(docs, usable)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.doc_id % 3 == 0 and r.doc_id < 300]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id in (300, 301)} == {300: ("und", 0.0), 301: ("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(rows)


def test_every_language_is_learned(spark):
    rows = spark.range(430).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 215).alias("lang"))
    model = language_id.fit(rows.withColumn("text", F.repeat(F.concat("lang", F.lit(" ")), F.lit(3))), F.lit(True))
    assert len(model.languages) == 215


def test_language_edges(docs, nothing):
    rows = language_id.identify(docs, language_id.fit(docs, F.lit(True))).collect()
    assert len(rows) == len(TEXTS) and {r.lang_pred for r in rows} == {"en", "und"}
    empty = language_id.fit(nothing, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}


def test_quality_classifier(spark, docs, nothing):
    rng = random.Random(6)
    good = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=60)) for _ in range(120)]
    bad = ["!!".join(rng.choices(["BUY", "NOW", "CHEAP"], k=60)) for _ in range(120)]
    texts = good + bad
    known = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    labels = [(n, int(n < 120)) for n in range(240)] + [(None, 1), (7, None), (9999, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    sample = quality_zstd.labelled_sample(known, labels, F.col("doc_id") % 4 != 0)
    assert (len(sample[0]), len(sample[1])) == (90, 90)
    model = quality_zstd.train(*sample)
    rows = quality_zstd.score_documents(known, model).collect()
    held = [r for r in rows if r.doc_id % 4 == 0]
    assert all(r.predicted == int(r.doc_id < 120) for r in held)
    edge = quality_zstd.score_documents(docs, model).collect()
    assert len(edge) == len(TEXTS) and all(0 <= r.score <= 1 for r in edge)
    assert quality_zstd.score_documents(nothing, model).count() == 0
    assert {r.score for r in quality_zstd.score_documents(docs, quality_zstd.train([], [])).collect()} == {0.5}


def test_quality_rules_by_definition(spark):
    rng = random.Random(8)
    texts = TEXTS[:-1] + [" ".join(rng.choices(["a", "b#", "\n", "c c", "d|e"], k=rng.randrange(120))) for _ in range(150)]
    docs = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "doc_id long, text string, ratio int")
    labels = spark.createDataFrame([(n, 1) for n in range(50)] + [(None, 1)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    assert len(found) == len(texts)
    for n, text in enumerate(texts):
        words = (text or "").encode().split()
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        row = found[n]
        assert row.n_words == len(words) and row.n_repeat_words == len(again)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (len(words) < 20 or 100 * len(again) > 30 * len(words))
        assert not (row.base_failed and row.kept)


def test_quality_rules_count_all_trusted_documents(spark):
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    table = quality_rules.ratios(docs, docs.select("doc_id")).first()["ratio"]
    assert len(table) == quality_rules.BUCKETS and set(table) == {0.0}


def test_quality_rules_threshold_is_exact(spark):
    values = spark.range(150_000).select((F.xxhash64("id") / 3e18 * F.rand(3)).alias("ratio")).persist()
    values = values.unionByName(values.limit(500))
    known = sorted(r.ratio for r in values.collect())
    for share in (0.002, 0.5, 1.0):
        assert quality_rules.lowest(values, share).first()["t"] == known[math.ceil(len(known) * share) - 1]
    assert quality_rules.lowest(values.limit(0), 0.002).first()["t"] is None


def test_quality_rules_edges(docs, nothing):
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert quality_rules.judge(docs, labels).count() == len(TEXTS)
    rows = quality_rules.judge(docs, labels.limit(0)).collect()
    assert {r.ratio for r in rows} == {0.0} and all(r.kept != r.base_failed for r in rows)
    assert quality_rules.judge(nothing, labels).count() == 0


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, lambda d: zstandard.ZstdCompressor().compress(d)])
def test_secrets_in_content_of_any_length(pack, monkeypatch):
    """Bytes after the content, content compressed again, a fault and a second copy, short or in pieces."""
    plain = random.Random(7).randbytes(6000).hex().replace("a", " ").encode() + b"\npassword=abcdef123 "
    plain += b"".join(b"%d.." % n for n in range(2000))
    cut = bytearray(pack(plain))
    cut[-4:] = b"\x01\x02\x03\x04"
    cases = [pack(plain) + b"rest of it", pack(pack(plain)), pack(pack(pack(plain))), bytes(cut)]
    texts = ["see " + "".join(f"%{c:02x}" for c in case) + " end" for case in cases]
    texts += [f"{text} and {text}" for text in texts]
    expected = [secret_scan.find(text) for text in texts]
    for _, spans, unopened in expected[:3]:
        assert unopened == 0 and "assign" in {kind for *_, kind in spans}
    monkeypatch.setattr(secret_scan, "PIECE", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 200)
    assert [secret_scan.find(text) for text in texts] == expected


def test_text_that_begins_like_compressed_bytes():
    found = secret_scan.find(base64.b64encode(gzip.compress(b"x^2 = y, password=abcdef123 and more")).decode())
    assert "assign" in {kind for *_, kind in found[1]}
