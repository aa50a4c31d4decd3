"""Periodic runs, line dedup and spelling variants against brute force, and on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import line_dedup, periodic, variants
from riskloom.llm.common import table
from riskloom.llm.queries import REGISTRY
from tests.llm.test_operators import LOWER, SF, WORDS, awkward, empty, sf_docs, texts  # noqa: F401

# --- periodic runs


def brute_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                out.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    draw = np.random.default_rng(seed)
    for _ in range(150):
        lists = []
        for _ in range(draw.integers(1, 5)):
            n = int(draw.integers(0, 90))
            w = draw.integers(0, draw.choice([1, 2, 3, 8, 40]), n).tolist()
            for _ in range(draw.integers(0, 4) if n else 0):
                a, p = int(draw.integers(0, n)), int(draw.integers(1, 13))
                for i in range(a, int(draw.integers(a, n)) + 1):
                    w[i] = w[a + (i - a) % p]
            lists.append(w)
        bounds = np.cumsum([0, *map(len, lists)])
        got = periodic.word_runs(np.array(sum(lists, []), np.int64), bounds)
        assert got.tolist() == [[s + b, length, q] for w, b in zip(lists, bounds.tolist()) for s, length, q in brute_runs(w)]


def test_collisions_do_not_change_runs(monkeypatch):
    monkeypatch.setattr(periodic, "mix", lambda keys: keys * np.uint64(0))
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 4, 4, 4, 4, 4, 4, 4] * 2)
    got = periodic.word_runs(words, np.array([0, 40]))
    assert got.tolist() == [list(r) for r in brute_runs(words.tolist())]


def test_splitting_leaves_only_frequent_words():
    words = np.array([0, 1, 2, 3, 1, 2, 1, 2, 1, 2, 1, 2, 9, 1, 2, 4, 5, 3, 3, 1, 1])
    place, segment = periodic.frequent_segments(words, np.zeros(21, np.int64))
    assert place.tolist() == list(range(4, 12)) and set(segment) == {0}


def test_one_long_run():
    assert periodic.word_runs(np.zeros(100_000, np.int64), np.array([0, 100_000])).tolist() == [[0, 100_000, 1]]


def test_periodic_query(spark, texts):  # noqa: F811
    got = {r["doc_id"]: r for r in REGISTRY["op11_periodic_runs"](spark, SF).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        words = planted(doc_id, WORDS.findall(text or ""))
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_periodic_awkward(awkward, empty):  # noqa: F811
    rows = awkward.collect()
    found = periodic.periodic_runs(awkward).collect()
    assert len(found) == len(rows)
    by_text = defaultdict(set)
    for r, f in zip(rows, found):  # nothing is shuffled, so the order stays
        words = WORDS.findall(r["text"] or "")
        if len(words) < 1000:
            runs = brute_runs(words)
            assert [tuple(x) for x in f["runs"]] == runs and f["collapsed"] == collapsed(words, runs)
        by_text[r["text"]].add((f["n_words"], f["collapsed"], tuple(map(tuple, f["runs"]))))
    assert all(len(x) == 1 for x in by_text.values())
    assert any(f["n_words"] == 90_000 and [tuple(x) for x in f["runs"]] == [(0, 90_000, 3)] and f["collapsed"] == "alpha beta gamma" for f in found)
    assert periodic.periodic_runs(empty).count() == 0
    assert periodic.run_digests(periodic.periodic_runs(periodic.with_planted_runs(awkward))).count() == len(rows)
    assert periodic.with_planted_runs(awkward).columns == awkward.columns


# --- line dedup


def brute_lines(rows):
    """(id, text) rows -> (n_lines, n_dropped, kept) each."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first = {}
    for doc_id, text in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                k = key(line)
                if len(k) >= 10:
                    first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or first.get(key(x), doc_id) >= doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def plain(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str)


@pytest.mark.parametrize("batches,fan", [(1, 2), (3, 2), (7, 2), (6, 3)])
def test_lines_at_any_number_of_batches(spark, batches, fan):
    draw = np.random.default_rng(batches)
    pool = [f"  Line number {k} of the pool\t" for k in range(30)] + [f"line NUMBER {k} of the pool" for k in range(30)] + ["", "short", "ÉÀ ÇÇ ÉÉ ÀÀ", "éà çç éé àà"]
    rows = [(int(i), "\n".join(draw.choice(pool, draw.integers(0, 9)))) for i in draw.permutation(60)]
    rows += [(200 + i, "the very same line\nand one of " + str(i)) for i in range(400)]  # a hot key
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert plain(line_dedup.dedup_lines(docs, batches=batches, fan=fan)) == sorted(brute_lines(rows), key=str)


def test_lines_awkward(spark, awkward, empty):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    rows += [(100, "a text without an id"), (101, "A TEXT WITHOUT AN ID \nnew"), (None, "A text without an id\n\n"), (102, "\n" * 5)]
    docs = awkward.select("doc_id", "text").limit(0).union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert plain(line_dedup.dedup_lines(docs)) == sorted(brute_lines(rows), key=str)
    assert line_dedup.dedup_lines(awkward).count() == awkward.count()
    assert line_dedup.dedup_lines(empty).count() == 0
    names = spark.createDataFrame([("b", "shared line of text"), ("a", "shared line of text\nown")], "name string, body string")
    assert sorted(map(tuple, line_dedup.dedup_lines(names, "name", "body").collect())) == [("a", 2, 0, "shared line of text\nown"), ("b", 1, 1, "")]


def test_lines_leave_no_tables(spark, sf_docs):  # noqa: F811
    line_dedup.dedup_lines(sf_docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("riskloom_run")]


# --- spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


@pytest.mark.parametrize("most", [2, 5, 4_096])
def test_variants_at_any_block_size(spark, most):
    draw = np.random.default_rng(most)
    words = {"".join(draw.choice(list("abé"), draw.integers(1, 8))) for _ in range(250)} | {"a" * k for k in range(1, 30)}
    counts = {w: int(draw.integers(1, 60)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted(map(tuple, variants.spelling_variants(df, most=most).collect())) == brute_variants(counts)


def test_blocks_are_bounded(spark):
    words = [(f"{'q' * 10}{a}{b}{c}{'z' * 9}", 1) for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    for part in variants.blocks(spark.createDataFrame(words, "word string, n bigint"), 20):
        # an interval of one letter may hold two letters of a longer word, so 36 here
        assert part.filter("size(words) > if(high - low = 1, 42, 20)").count() == 0


def test_variants_query(spark, texts):  # noqa: F811
    counts = Counter()
    for doc_id, text in texts.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    got = {r["word"]: tuple(r) for r in REGISTRY["op13_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert set(got) == set(kept) and all(got[w][3] == n for w, n in kept.items())
    sample = {w for w in kept if zlib.crc32(w.encode()) % 40 == 0}
    for w in sample:  # the brute force is quadratic
        near = [v for v in kept if one_edit(w, v)]
        best = min(near, key=lambda v: (-kept[v], v), default=None)
        form = best if best is not None and kept[best] >= 2 * kept[w] else None
        assert (got[w][1], got[w][4], got[w][5]) == (form, len(near), kept.get(form))
    assert all((r[2] == w) if r[1] is None else (r[2] == got[r[1]][2]) for w, r in got.items())


def test_variants_awkward(spark, awkward, empty):  # noqa: F811
    words = variants.vocabulary(variants.letter_runs(awkward), least_count=1)
    counts = dict(map(tuple, words.collect()))
    assert sorted(map(tuple, variants.spelling_variants(words).collect())) == brute_variants(counts)
    assert variants.spelling_variants(variants.vocabulary(variants.letter_runs(empty))).count() == 0
    assert variants.with_planted_slips(variants.letter_runs(awkward)).filter("doc_id is null").count() > 0
    odd = spark.createDataFrame([(None, 3), ("", 2), ("a", 9), ("b", 1), ("x" * 3000, 4), ("x" * 2999 + "y", 1)], "word string, n bigint")
    got = {r["word"]: r for r in variants.spelling_variants(odd.withColumn("near", odd["n"]).withColumn("root", odd["word"])).collect()}
    assert len(got) == 6 and got[None]["n_near"] == 0 and got[""]["n_near"] == 2 and got["b"]["form"] == "a"
    assert got["x" * 2999 + "y"]["root"] == "x" * 3000


# --- ids that are no numbers


def test_ids_of_text(spark):
    """Operators that need whole numbers take text of such and refuse other text; the rest takes any id."""
    from riskloom.llm import minhash, packing

    rows = [("7", "one two three four five six seven"), ("8", "one two three four five six seven"), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert {(r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(docs, count_links=False).collect()} == {(7, 7), (8, 7), (None, None)}
    assert {r["doc_id"] for r in packing.pack_documents(docs, "word_bpe_49k.json", end_id=0).collect()} == {7, 8, None}
    odd = spark.createDataFrame([("a7", "one two")], "doc_id string, text string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        packing.pack_documents(odd, "word_bpe_49k.json", end_id=0).collect()
    assert [r["doc_id"] for r in periodic.periodic_runs(odd).collect()] == [r["doc_id"] for r in line_dedup.dedup_lines(odd).collect()] == ["a7"]
