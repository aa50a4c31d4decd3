"""Each corpus operator against a brute-force version, and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskloom.llm import decontaminate, langid, lm_bloom, minhash, packing, quality_llr, token_counts, token_planes, toxicity, url_tree
from riskloom.llm.common import batch_ids, table
from riskloom.llm.queries import REGISTRY
from riskloom.sources.scratch import scratch_path

SF = "/root/testdata/sf0.001"
WORD_IDS = "word_bpe_49k.json"
BYTE_IDS = "byte_bpe_50k.json"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = "alpha beta gamma " * 30_000
TEXTS = [
    None, "", " \n\t ", "!!! ***", "a", "one two", "one two three four five six", "One two, three four five six.", LONG,
    "same text again and again and again", "same text again and again and again", "café ÉCOLE naïve œuvre straße", "日本語 テスト 🙂",
    "<|endoftext|> in a text <|startoftext|>", "it's we'll  double  space \x1c\x85 x", "x" * 5000,
]
CLASH = ["id", "digest", "word", "label", "rep", "band", "n", "row", "hash", "score", "bucket", "known_id", "_kept", "_bad", "a", "b"]


@pytest.fixture(scope="module")
def sf_docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(sf_docs):
    return {r["doc_id"]: r["text"] for r in sf_docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


@pytest.fixture(scope="module")
def awkward(spark):
    """NULL ids and texts, empty and very long texts, repeated rows and ids, and columns of clashing names."""
    rows = [(k, t, "en" if k % 2 else None, "s", 1) for k, t in enumerate(TEXTS)]
    rows += [(None, "a text without an id", "en", None, None), (3, "another text of id three", "en", "s", 2), rows[6], rows[6]]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` int" for c in CLASH)
    return spark.createDataFrame([r + (7,) * len(CLASH) for r in rows], schema)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


def brute_counts(text):
    words = WORDS.findall(text or "")
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), duplicates, len(covered)


# --- toxicity


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    lengths = np.array([5, 3, 1])
    emission[1, 3:] = emission[2, 1:] = 0
    p, expected = toxicity.marginals(emission, lengths, moves)
    pairs = np.zeros((2, 2))
    for row, n in enumerate(lengths):
        weights = {}
        for y in range(2**n):
            tags = [(y >> k) & 1 for k in range(n)]
            score = sum(emission[row, k] for k in range(n) if tags[k]) + sum(moves[a, b] for a, b in zip(tags, tags[1:]))
            weights[tuple(tags)] = math.exp(score)
        whole = sum(weights.values())
        for k in range(n):
            assert p[row, k] == pytest.approx(sum(w for t, w in weights.items() if t[k]) / whole)
        for tags, w in weights.items():
            for a, b in zip(tags, tags[1:]):
                pairs[a, b] += w / whole
    assert np.allclose(pairs, expected)


@pytest.mark.parametrize("width", [1, 3, 64])
def test_marginals_do_not_depend_on_blocks(width):
    """Texts cut into blocks have the marginals and expected moves of the whole chains."""
    rng = np.random.default_rng(width)
    sizes = np.array([300, 1, 64, 65, 0, 7])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    values, moves = rng.normal(size=bounds[-1]) * 2, rng.normal(size=(2, 2)) * 3
    rows, lengths, cells, first = toxicity.in_blocks(values, bounds, width)
    p, expected = toxicity.marginals(rows, lengths, moves, first)
    whole, of_whole, own, _ = toxicity.in_blocks(values, bounds, 300)
    q, pairs = toxicity.marginals(whole, of_whole, moves)
    assert np.allclose(p.ravel()[cells], q.ravel()[own]) and np.allclose(expected, pairs)


def test_toxic_scores_hold_out(spark):
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = toxicity.score_documents(docs, marks).join(marks, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.9 * len(held)
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        for s in r["spans"]:
            assert 0 <= s["start"] < s["end"] <= len(own[r["doc_id"]])
            assert re.search(r"\s", own[r["doc_id"]][s["start"] : s["end"]].strip()) or s["end"] - s["start"] > 0


def test_toxicity_awkward(spark, awkward, empty, labels):
    model_free = toxicity.score_documents(awkward, labels.limit(0)).collect()
    assert len(model_free) == awkward.count() and all(r["score"] == 0 for r in model_free)
    marks = spark.createDataFrame([(6, 1), (7, 1), (4, 0), (5, 0), (9, 0), (None, 1), (6, 1), (3, None)], "doc_id bigint, toxic int")
    rows = toxicity.score_documents(awkward, marks).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(empty, marks).count() == 0


# --- packing


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    counts[1:] = rng.integers(0, [2, 40, 3, 9][seed], 256)
    places = packing.make_plan(counts, 256, 128)
    runs, sequences = defaultdict(list), defaultdict(list)
    for length, rank, n, sequence, offset in places.tolist():
        runs[length].append((rank, n))
        for k in range(n):
            sequences[sequence + k].append((offset, length))
    for length in range(1, 257):
        at = 0
        for rank, n in sorted(runs[length]):
            assert rank == at
            at += n
        assert at == counts[length]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    least = -(-int((counts * np.arange(257)).sum()) // 256)
    assert len(sequences) <= 1.02 * least + 2


def test_configurations_are_optimal():
    sizes, demand = np.array([60, 50, 40]), np.array([10.0, 10.0, 20.0])
    basis = packing.configurations(sizes, demand, 100)
    assert sum(x for _, x in basis) == pytest.approx(20)  # 60+40 ten times, 50+50 five, 40+40 five
    assert np.allclose(sum(c * x for c, x in basis), demand)
    for config, _ in basis:
        assert (config * sizes).sum() <= 100


def packed_rows(df):
    rows = df.collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return rows, len(sequences)


def test_packing_pieces(spark, texts):
    rows, n = packed_rows(REGISTRY["op2_best_fit_packing"](spark, SF))
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORD_IDS))
    expected, total = set(), 0
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            expected.add((doc_id, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    assert len(rows) == len(expected) and n <= 1.02 * -(-total // 2048) + 1


def test_packing_awkward(awkward, empty):
    rows, _ = packed_rows(packing.pack_documents(awkward, WORD_IDS, 0))
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in awkward.collect()}
    assert sum(r["piece"] == 0 for r in rows) == awkward.count()
    assert packing.pack_documents(empty, WORD_IDS, 0).count() == 0


# --- language


def test_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_kernel_by_sets():
    """Kernel values with landmarks equal those of plain n-gram sets; unknown n-grams count in the norm."""
    samples = [("the quick brown fox jumps over the dog", "en"), ("der schnelle braune fuchs springt", "de"), ("le renard brun saute par dessus", "fr")] * 2
    model = langid.fit(samples, landmarks=3)
    grams = lambda t, n: {t[k : k + n] for k in range(len(t) - n + 1)}
    texts = ["the dog over the fox", "zzz qqq ## 123 the", "", "x", "äöü der fuchs"]
    marks = [s for s, _ in sorted(samples[:3], key=lambda x: x[1])]
    rows = model.presence([langid.characters(t) for t in texts]) @ model.presence([langid.characters(t) for t in marks]).T
    for k, t in enumerate(texts):
        for m, mark in enumerate(marks):
            expected = sum(
                len(grams(t, n) & grams(mark, n)) / math.sqrt(max(len(grams(t, n)), 1) * len(grams(mark, n))) for n in range(1, langid.N + 1)
            )
            assert rows[k, m] == pytest.approx(expected, abs=1e-5)


def test_ridge_by_the_whole_kernel():
    """With every sample a landmark, scores are those of kernel ridge regression on the whole kernel."""
    words = {"en": "the of and house water", "de": "der und das haus wasser", "fr": "le et la maison eau"}
    draw = np.random.default_rng(2)
    samples = [(" ".join(draw.choice(words[lang].split(), 12)), lang) for lang in ("de", "en", "fr") for _ in range(6)]
    model = langid.fit(samples, landmarks=len(samples))
    codes = [langid.characters(t) for t, _ in samples]
    presence = model.presence(codes).astype(float)
    kernel = presence @ presence.T
    targets = np.array([[2.0 * (lang == other) - 1 for other in model.languages] for _, lang in samples])
    got = model.scores(codes)
    assert (got.argmax(axis=1) == targets.argmax(axis=1)).all()
    values, vectors = np.linalg.eigh(kernel)
    assert values.min() > -1e-6
    # fitted values lie in the span of the kernel and follow the targets as its large directions do
    assert np.corrcoef(got.ravel(), targets.ravel())[0, 1] > 0.9


@pytest.mark.parametrize("name", [WORD_IDS, BYTE_IDS])
def test_batch_ids_of_any_tokenizer(name):
    texts = [t for t in TEXTS if t != LONG] + ["Tab\tand  spaces\n\nlines", "ALL CAPS Ünïcode ﬀ İ"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    ids, ends = batch_ids(pa.array(texts), name)
    for k, t in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_segments_cover():
    for n in (0, 1, 1023, 1024, 1600, 5000):
        cuts = langid.segments(n)
        assert cuts[0][0] == 0 and cuts[-1][1] == n and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))


def test_language_awkward(awkward, empty):
    rows = langid.identify(awkward).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] != 3}
    for k in (0, 1, 2):
        assert by[k]["lang_pred"] == "und" and by[k]["score"] == 0
    assert by[6]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(empty).count() == 0


# --- quality


def test_quality_counts_and_gap(spark):
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality_llr.quality(docs, marks).collect()
    for r in rows:
        expected = brute_counts(own[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r["base_failed"] and r["kept"])
    quality = {r["doc_id"]: r["quality"] for r in marks.collect()}
    judged = [(r["kept"], quality[r["doc_id"]]) for r in rows if not r["base_failed"] and r["doc_id"] in quality]
    assert sum(kept == bool(q) for kept, q in judged) >= 0.95 * len(judged)


def test_trusted_documents_are_scored_without_themselves():
    """Taking a text out by ``without_own`` equals counting the trusted texts again without it."""
    draw = np.random.default_rng(3)
    lists = [draw.integers(0, 30, n) for n in (5, 1, 40, 12)]
    grams, text = np.concatenate(lists), np.repeat(np.arange(4), [len(x) for x in lists])
    good = np.array([True, False, True, True])
    counts = np.zeros((quality_llr.BUCKETS, 2))
    counts[:30, 1] = 100
    for x, g in zip(lists, good):
        counts[:, 0] += g * np.bincount(x, minlength=quality_llr.BUCKETS)
    got = quality_llr.ratios_of(counts)[grams] + quality_llr.without_own(counts, grams, text, good)
    for k, x in enumerate(lists):
        left = counts.copy()
        left[:, 0] -= good[k] * np.bincount(x, minlength=quality_llr.BUCKETS)
        assert got[text == k] == pytest.approx(quality_llr.ratios_of(left)[x])


def test_withheld_good_documents_are_kept(spark):
    """Labels of one fold are withheld; their good documents are kept about as often as the fitted ones."""
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    kept = {r["doc_id"]: r["kept"] for r in quality_llr.quality(docs, marks.filter("pmod(crc32(cast(doc_id as string)), 5) <> 0")).filter("not base_failed").collect()}
    share = {}
    for held in (True, False):
        own = [kept[r["doc_id"]] for r in marks.filter("quality = 1").collect() if r["doc_id"] in kept and (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == held]
        share[held] = sum(own) / len(own)
    assert share[True] >= share[False] - 0.05


def test_one_distribution_is_not_split(spark):
    """Labels without meaning: fresh texts are not rejected beside kept good ones."""
    draw = np.random.default_rng(9)
    texts = [" ".join(f"w{k}" for k in draw.integers(0, 400, 60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id bigint, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_llr.quality(docs, marks).collect()}
    assert np.mean([kept[k] for k in range(200, 300)]) > 0.8


def test_log_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c c")], "doc_id bigint, text string")
    ratios = quality_llr.log_ratios(docs, docs.select("doc_id").limit(1))
    grams, inside = quality_llr.n_grams(np.array([0, 1]), quality_llr.word_hashes(pa.array(["a", "b"])), np.array([0, 2]))
    assert inside.tolist() == [True]
    raw, good = 3 + 2 + 2 - 1 + 2, 3  # n-grams: a, b, ab | a, c, c, ac, cc
    expected = math.log(1.5 / (good + 0.5 * quality_llr.BUCKETS)) - math.log(2.5 / (raw + 0.5 * quality_llr.BUCKETS))
    assert ratios[grams[0]] == pytest.approx(expected)


def test_threshold_of_all_labelled(spark):
    """The threshold equals a plain search over all labelled scores, whatever their number."""
    draw = np.random.default_rng(5)
    for n, classes in ((0, 2), (1, 2), (400, 2), (50, 1), (30_000, 2)):
        label = draw.integers(0, classes, n)
        score = np.round(draw.normal(size=n) + label, 3)
        judged = spark.createDataFrame([(float(a), int(b)) for a, b in zip(score, label)], "score double, label int").repartition(3)
        found = quality_llr.best_threshold(judged)
        values = np.unique(score)
        if len(set(label)) < 2 or len(values) < 2:
            assert found == -np.inf
            continue
        cost = np.array([10.0 * ((score <= v) & (label == 1)).sum() + ((score > v) & (label == 0)).sum() for v in values[:-1]])
        gap = np.where(cost == cost.min(), np.diff(values), -1)
        at = int(np.argmax(gap))
        assert found == (values[at] + values[at + 1]) / 2


@pytest.mark.parametrize("at_once", [500_000, 9_000])
def test_quality_reads_every_label(spark, monkeypatch, at_once):
    """More trusted documents than a pass takes: all of them count as trusted, and every row once as raw."""
    from pyspark.sql import functions as F

    from riskloom.llm.common import labelled_ids

    monkeypatch.setattr(quality_llr, "ROUND", at_once)
    marks = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    docs = marks.select("doc_id", F.lit("a b").alias("text"))
    counts = quality_llr.bucket_counts(docs.union(spark.createDataFrame([(-1, "c")], docs.schema)), labelled_ids(marks, "quality"))
    assert counts.sum(axis=0).tolist() == [150_000, 150_001]


def test_quality_rounds_change_nothing(spark, monkeypatch):
    docs, marks = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    whole = sorted(map(tuple, quality_llr.quality(docs, marks).collect()))
    monkeypatch.setattr(quality_llr, "ROUND", marks.count() // 3)
    assert sorted(map(tuple, quality_llr.quality(docs, marks).collect())) == whole


def test_quality_awkward(awkward, empty, labels):
    rows = quality_llr.quality(awkward, labels).collect()
    assert len(rows) == awkward.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] != 3}
    for k, text in enumerate(TEXTS):
        if k != 3:
            assert (by[k]["n_words"], by[k]["word_chars"], by[k]["n_symbols"], by[k]["n_dup_lines"], by[k]["n_repeat_words"]) == brute_counts(text)
    assert quality_llr.quality(empty, labels).count() == 0


# --- urls


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    best = (None, None)
    for rule, verdict in url_tree.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


URLS = [
    None, "", "no scheme", "http://", "http://a.ORG", "http://a.org/", "https://EXAMPLE.org/es/1?x#y", "http://example.org/en/12", "http://example.org/en/2",
    "http://x.com/fr/1", "http://com/de/5", "http://xcom/de/5", "http://É.org/a", "a://b://c/d", "http://h.net?q=/x", "http://h.net#/x", "http://h.net/\nnew",
]


def test_urls(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    odd = spark.createDataFrame([(k, u, None) for k, u in enumerate(URLS)] + [(None, URLS[5], None), (5, URLS[5], None)], "page_id bigint, url string, html string")
    for df in (pages, odd):
        own = {r["page_id"]: r["url"] for r in df.collect()}
        rows = url_tree.judge_urls(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            host, path, rule, verdict = brute_url(own[r["page_id"]])
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert r["verdict"] == (verdict or ("block" if r["purity"] >= url_tree.REJECT else "allow"))
    assert url_tree.judge_urls(odd.limit(0)).count() == 0


def test_tree_rejects_a_pure_template(spark):
    """Slugs become one wildcard, and its labelled share decides for urls that no rule fits."""
    rules = [("shop.net/buy/x", "block"), ("shop.net/read/", "allow")]
    rows = [(k, f"http://shop.net/buy/{'x' if k % 3 else 'y'}slug-{k}q") for k in range(120)]
    rows += [(1000 + k, f"http://shop.net/read/{k}") for k in range(120)] + [(2000, "http://shop.net/about")]
    got = {r["page_id"]: r for r in url_tree.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect()}
    assert got[0]["rule"] is None and got[0]["template"] == "/buy/*" and got[0]["verdict"] == "block"
    assert got[2000]["verdict"] == "allow" and got[1000]["purity"] < 0.2


# --- decontamination


def brute_contamination(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        for k in range(max(len(words) - 12, 1) if words else 0):
            windows[tuple(words[k : k + 13])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if (w := tuple(words[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def key(rows):
    return sorted(((-1 if r[0] is None else r[0],) + tuple(r[1:]) for r in rows))


def test_contamination(spark, awkward, empty):
    items = [(1, "one TWO three four five six"), (2, "one two three"), (10, None), (11, "..."), (12, "école Éa"), (13, " ".join(f"w{k}" for k in range(20))), (14, "one two three")]
    items += [(15, "alpha beta gamma " * 6), (None, "same text")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["text"] != LONG] + [(99, ". " + " ".join(f"W{k}" for k in range(4, 30)))]
    rows += [(100, "école ÉA and École Éa"), (101, "Kelvin one tWo threE"), (102, "one two three")]
    docs = spark.createDataFrame([r + (0, 0) for r in rows], "doc_id bigint, text string, id int, digest int")
    got = decontaminate.contamination(docs, bench).collect()
    assert key(got) == key(brute_contamination(rows, [i for i in items if i[0] is not None]))
    assert decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)
    kept = decontaminate.without_hits(docs, bench)
    bad = {r["doc_id"] for r in got if r["contaminated"]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - bad


@pytest.mark.parametrize("most,piece", [(700, 4096), (10**6, 5)])
def test_contamination_in_rounds_and_pieces(spark, monkeypatch, most, piece):
    """Neither a benchmark beyond one broadcast nor cuts of the texts change a result."""
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    if piece < 100:
        docs = docs.filter("length(text) < 3000")
    one = key(decontaminate.contamination(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    assert key(decontaminate.contamination(docs, bench).collect()) == one


@pytest.mark.parametrize("mark", [" ", ".", "'", ":", "\n"])
def test_contamination_of_greek(spark, mark):
    """Capital sigma lower-cases by context, which the contract's A-Z lowering must not."""
    words = ["ΑΒΓΔΕΖΗΣ", "ΗΣ", "ΑΒ", "ας", "ΣΑΣ", "İstanbul", "K", "a", "b", "c", "d", "E", "f"]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    docs = spark.createDataFrame([(1, mark.join(words)), (2, mark.join(w.lower() for w in words))], "doc_id int, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: 13, 2: 0}


def test_clean_rows_stay_beside_hits_of_the_same_id(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id int, text string")
    rows = [(None, "one two three four"), (None, "clean"), (None, "clean"), (5, "One two. Three four"), (5, "also clean"), (6, "clean"), (None, None)]
    kept = decontaminate.without_hits(spark.createDataFrame(rows, "doc_id int, text string"), bench).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [rows[k] for k in (1, 2, 4, 5, 6)]))
    named = spark.createDataFrame([("a", "one two three four"), ("b", "clean")], "doc_id string, text string")
    assert [r["doc_id"] for r in decontaminate.without_hits(named, bench).collect()] == ["b"]


# --- token counts and planes


def test_token_counts(spark, texts, awkward, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTE_IDS))
    rows = REGISTRY["op7_token_counts"](spark, SF).collect()
    for r in rows:
        assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024)
    by = defaultdict(set)
    for r in token_counts.token_counts(awkward, BYTE_IDS, 1024).collect():
        by[r["doc_id"]].add(r["n_tokens"])
    for k, text in enumerate(TEXTS):
        assert len(tokenizer.encode(text or "", add_special_tokens=False).ids) in by[k]
    assert token_counts.token_counts(empty, BYTE_IDS, 1024).count() == 0


def test_batch_ids_match_library():
    rng = np.random.default_rng(3)
    letters = list("aZé.,'!_1 \n\tßÀµª²½×÷\xa0\x85\xad\x1cst, . İΣσ日🙂")
    odd = ["".join(rng.choice(letters, rng.integers(0, 15))) for _ in range(5000)] + [t for t in TEXTS if t is not None]
    for name in (WORD_IDS,):
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        ids, ends = batch_ids(pa.array(odd), name)
        for k, text in enumerate(odd):
            assert ids[ends[k] : ends[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_piece_counts_match_library():
    rng = np.random.default_rng(4)
    letters = list("aZé.,'!_1 \n\tßÀµª²½×÷\xa0\x85\xad\x1cst, . İΣσ日🙂'") + ["'s", "'ll", "<|endoftext|>"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTE_IDS))
    counts = token_counts.PieceCounts(tokenizer)
    for _ in range(5000):
        text = "".join(rng.choice(letters, rng.integers(0, 15)))
        assert counts.text(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("ids", [[], [0], [0, 0, 0], [1, 49407, 65535, 65536, 2**32 - 1], list(range(1000))])
def test_planes_round_trip(ids, bits):
    ids = np.array(ids, "<u4")
    sizes, counts, planes, payload = token_planes.encode_chunk(ids, 64, bits, 3)
    assert token_planes.decode_chunk(sizes, counts, planes, payload, bits).tolist() == ids.tolist()
    assert all(n == 64 for n in sizes[:-1])


@pytest.mark.parametrize("bits", [False, True])
def test_token_files(spark, awkward, empty, bits):
    path = scratch_path(spark, "tokens")
    token_planes.write_token_files(awkward, path, WORD_IDS, 2, block_ids=100, chunk_ids=500, bits=bits)
    rows = sorted(token_planes.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORD_IDS))
    expected = sorted(((r["doc_id"], r["text"]) for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    assert len(rows) == len(expected)
    for r, (doc_id, text) in zip(rows, expected):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids"]) == (doc_id, at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    path = scratch_path(spark, "tokens")
    token_planes.write_token_files(empty, path, WORD_IDS, 2)
    assert token_planes.read_token_files(spark, path).count() == 0


# --- near-duplicates


def brute_classes(docs, similarity=0.8):
    def sets(text):
        words = [w for w in (t.strip(minhash._SIGNS) for t in re.findall(r"[^ \t\n\v\f\r]+", (text or "").lower())) if w]
        return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else None

    own = {k: s for k, t in docs if (s := sets(t))}
    holders = defaultdict(list)
    for k, s in own.items():
        for g in s:
            holders[g].append(k)
    both = Counter(p for v in holders.values() for p in combinations(sorted(v), 2))
    root = {k: k for k, _ in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), n in both.items():
        if n / (len(own[a]) + len(own[b]) - n) >= similarity and find(a) != find(b):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: find(k) for k, _ in docs}


def test_near_duplicates(spark, texts):
    got = {r["doc_id"]: r["class_id"] for r in REGISTRY["op9_minhash"](spark, SF).collect()}
    assert got == brute_classes(list(texts.items()))


def test_near_copies_around_the_threshold(spark, monkeypatch):
    """A family of edits of one text, many of them just under the threshold from its least id."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for k in range(150):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            words[at] = f"x{rng.integers(0, 3)}"
        docs.append((k, " ".join(words)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == brute_classes(docs)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(6)
    hashes = rng.integers(1, 2**63, 300).astype(np.uint64)
    one, two = hashes[:200], hashes[100:]
    text = np.repeat([0, 1], 200)
    weights = np.concatenate([np.r_[np.full(100, 1), np.full(100, 3)], np.r_[np.full(100, 3), np.full(100, 2)]])
    found = minhash.signatures(text, np.concatenate([one, two]), weights, 2, 4096)
    a, b = dict(zip(one, weights[:200])), dict(zip(two, weights[200:]))
    exact = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())
    assert (found[0] == found[1]).mean() == pytest.approx(exact, abs=0.03)


def test_links_are_counted_inside_a_class(spark, monkeypatch):
    """Near copies that all are similar, in several blocks, beside a pair and a text alone."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(f"x{k}" if k and j == 30 + k % 3 else w for j, w in enumerate(base))) for k in range(40)]
    docs += [(50, " ".join(f"y{j}" for j in range(90))), (51, " ".join(f"y{j}" for j in range(91))), (52, "alone here")]
    docs.append((60, docs[7][1]))  # a copy of one text is no other text
    rows = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == {**{k: 39 for k in range(40)}, 50: 1, 51: 1, 52: 0, 60: 39}


def test_repeated_passages_do_not_hide_a_pair(spark):
    """Texts of the same shingles, one of which holds a passage 60 times more: only their sets are alike."""
    docs = []
    for k in range(30):
        cycle = [f"p{k}w{j}" for j in range(25)]
        rest = [f"q{k}w{j}" for j in range(175)]
        docs.append((2 * k, " ".join(cycle * 2 + rest)))
        docs.append((2 * k + 1, " ".join(cycle * 62 + rest)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == brute_classes(docs) == {k: k // 2 * 2 for k, _ in docs}


def test_near_duplicates_awkward(awkward, empty):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add(r["class_id"])
    assert by[0] == {0} and by[1] == {1} and by[2] == {2} and by[None] == {None}
    assert by[9] == by[10] == {9} and by[6] == by[7] == {6}
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40) if k != 20], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in minhash.components(links).collect()}
    assert got == {k: 0 if k <= 20 else 21 for k in range(41)}


# --- language model


def test_base_scores(spark, texts):
    rows = lm_bloom.lm_scores(table(spark, SF, "documents")).collect()
    tokens = {k: WORDS.findall(t.translate(LOWER)) + [""] for k, t in texts.items()}
    counts = Counter(w for k, own in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in own)
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[w] > 0 for w in own), total)
        expected = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        assert r["base_score"] == pytest.approx(expected)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) and r["score"] < 0
    seen, unseen = ([r for r in rows if r["held_out"] == h] for h in (False, True))
    mean = lambda rs: sum(r["score"] for r in rs) / sum(r["n_tokens"] for r in rs)
    assert mean(seen) > mean(unseen)


def test_filter_counts(spark):
    """Every count read back is at least the quantised one, and nearly always equal to it."""
    texts = spark.createDataFrame([(" ".join(f"w{k % (j + 1)}" for k in range(50)),) for j in range(40)], "text string")
    held = {r["shard"]: r for r in lm_bloom.filter_shards(texts, 3).collect()}
    words, pairs = Counter(), Counter()
    for r in texts.collect():
        grams = lm_bloom._gram_hashes(pa.array([r["text"]]))
        words.update(grams[: len(grams) // 2].tolist())
        pairs.update(grams[len(grams) // 2 :].tolist())
    assert sum(r["total"] for r in held.values()) == sum(words.values()) == 40 * 51
    assert sum(r["distinct"] for r in held.values()) == len(words)
    same = []
    for grams, name in ((words, lambda k: k), (pairs, lm_bloom.in_shard)):
        keys = np.array(list(grams), np.uint64)
        expected = lm_bloom.quantise(np.array(list(grams.values())))
        shard = lm_bloom.shard_of(keys, 3)
        for k, r in held.items():
            model = lm_bloom.Filter(np.frombuffer(r["bits"], np.uint8))
            got = model.levels(name(keys[shard == k]))
            assert (got >= expected[shard == k]).all() and 0 < model.density() < 0.5
            same += (got == expected[shard == k]).tolist()
    assert np.mean(same) > 0.9


@pytest.mark.parametrize("width", [1, 4, 5, 8])
def test_planes_of_values(width):
    values = np.random.default_rng(width).integers(0, 1 << (8 * width - 1), 1000).astype(np.uint64)
    assert (lm_bloom.from_planes(lm_bloom.planes(values, width), width) == values).all()


def test_equal_texts_get_equal_scores(spark):
    rows = [(k, "the same text in many rows " * 9) if k % 2 else (k, f"row {k} " + "x y z " * (k % 7)) for k in range(200)]
    got = lm_bloom.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).filter("doc_id % 2 = 1").collect()
    assert len(got) == 100 and len({(r["score"], r["base_score"]) for r in got}) == 1


def test_language_model_awkward(awkward, empty):
    rows = lm_bloom.lm_scores(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r["n_tokens"] >= 1 and np.isfinite(r["score"]) and np.isfinite(r["base_score"])
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert lm_bloom.lm_scores(empty).count() == 0


@pytest.mark.parametrize("copies", [1, 4, 16])
def test_score_error_does_not_grow_with_the_corpus(spark, monkeypatch, copies):
    """Against exact n-gram counts, with a filter of several shards and texts in several blocks."""
    monkeypatch.setattr(lm_bloom, "SHARD_GRAMS", 5_000)
    rng = np.random.default_rng(copies)
    docs = [(k, " ".join(f"w{j}" for j in rng.zipf(1.3, 300) % 5000)) for k in range(60 * copies)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    grams = Counter()
    for k, t in docs:
        if zlib.crc32(str(k).encode()) % 5 != 1:
            grams.update(lm_bloom._gram_hashes(pa.array([t])).tolist())

    class Exact:
        train_tokens = sum(grams.values()) // 2

        def levels(self, keys):
            return np.where(n := np.array([grams[k] for k in keys.tolist()]), lm_bloom.quantise(n), 0)

    monkeypatch.setattr(lm_bloom, "BLOCK_BYTES", 20_000)
    asked = {r["doc_id"]: r for r in lm_bloom.lm_scores(frame).collect()}
    assert asked.keys() == {k for k, _ in docs}
    errors = []
    for k, t in docs:
        codes, words, bounds = lm_bloom.batch_words(lm_bloom.lowered(pa.array([t])))
        hashes = np.append(lm_bloom.word_hashes(words), lm_bloom._END_HASH)
        tokens, bounds = lm_bloom.with_ends(codes, bounds, len(words))
        counts = lm_bloom.count_of(Exact().levels(hashes))
        exact = lm_bloom.log10_probabilities(Exact(), hashes[tokens], bounds[:-1], counts[tokens]).sum()
        errors.append(abs(asked[k]["score"] - exact) / len(tokens))
    assert np.mean(errors) < 0.02
