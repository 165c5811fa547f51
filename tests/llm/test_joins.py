"""Search, spelling variants and shingle links against plain versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from terrace.llm import jaccard, lexical, variants
from terrace.staging import stage

LOWER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# Ranked lexical search


def plain_ranking(docs, items, top):
    found = {i: Counter(TERM.findall((text or "").translate(LOWER))) for i, text in docs}
    n_docs, n_terms = sum(bool(c) for c in found.values()), sum(sum(c.values()) for c in found.values())
    df = Counter(t for c in found.values() for t in c)
    rows = []
    for item, text in set(items):
        scores = []
        for id_, counts in found.items():
            m = 100 - 50 + 50 * sum(counts.values()) * n_docs // n_terms
            terms = set(TERM.findall((text or "").translate(LOWER))) & set(counts)
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m)) for t in terms)
            if score > 0:
                scores.append((-score, id_))
        rows += [(item, place, id_, -score) for place, (score, id_) in enumerate(sorted(scores)[:top], 1)]
    return sorted(rows)


def texts(r, n, words):
    """Texts of skewed words with capitals, digits, signs and letters that are not ASCII; some long, some empty."""
    vocabulary = ["".join(r.choice("abcdeéßÀ中9") for _ in range(r.randrange(1, 6))) for _ in range(words)]
    make = lambda size: " -".join(r.choice(vocabulary[: r.randrange(1, words)]) for _ in range(size)).title()
    return [(i, None if i % 97 == 0 else make(r.choice([0, 1, 5, 40, 40, 900]))) for i in range(n)]


@pytest.mark.parametrize("batch_terms", [200_000, 40])
def test_ranking(spark, batch_terms):
    r = random.Random(11)
    docs, items = texts(r, 600, 400), [(i, text and text[:300]) for i, text in texts(r, 25, 400)]
    docs += [(1000 + i, docs[7][1]) for i in range(80)]  # ties: copies
    docs_df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    items_df = spark.createDataFrame(items + items[:3], "item_id bigint, text string")
    found = lexical.ranked(docs_df, items_df, top=9, batch_terms=batch_terms, probes=10).collect()
    assert sorted(map(tuple, found)) == plain_ranking(docs, items, 9)


def test_bounds_are_never_below_scores_and_mostly_equal():
    r = random.Random(5)
    docs = [(i, text.encode()) for i, text in texts(r, 300, 300) if text]
    counts = [Counter(lexical.terms_of(t)) for _, t in docs]
    n_terms = sum(sum(c.values()) for c in counts)
    terms = sorted({t for c in counts for t in c})
    rows = [(item, t.decode(), r.randrange(1, 9000)) for item in range(20) for t in r.sample(terms, 30)]
    asked = lexical.Queries(rows, len(docs), n_terms)
    held = [lexical.entries(np.array(list(c.values()), np.int64), np.array([lexical.xxhash.xxh64_intdigest(t, 42) for t in c], np.uint64)) for c in counts]
    width = lexical.width_of(max(map(len, held)))
    bits = np.zeros((width, len(docs)), bool)
    for at, own in enumerate(held):
        bits[lexical.places(own, width).reshape(-1), at] = True
    lengths = [sum(c.values()) for c in counts]
    close = 0
    for item, bounds in asked.bounds(width, lengths, np.packbits(bits, axis=1).tobytes()):
        scores = np.array([asked.score(item, c, int(m)) for c, m in zip(counts, asked.shortness(lengths))])
        assert (bounds >= scores).all()
        close += (bounds <= 1.1 * scores).sum()
    assert close > 0.99 * 20 * len(docs)


# Spelling variants


def plain_neighbours(words):
    cut, pairs = defaultdict(set), set()
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            cut[i, rest].add(w)
            if rest in words:
                pairs.add(tuple(sorted((w, rest))))
    return pairs | {tuple(sorted((a, b))) for group in cut.values() for a in group for b in group if a != b}


def test_neighbours(spark):
    """Words of few letters, repeated letters, and long words with edits anywhere, also where edges have many letters."""
    r = random.Random(2)
    words = {"".join(r.choice("abÿ") for _ in range(r.randrange(7, 10))) for _ in range(500)} | {"a" * n for n in range(7, 60)}
    for size in (20, 36, 37, 38, 39, 40, 45, 70, 71, 150, 700):
        base = "".join(r.choice("abcdé") for _ in range(size))
        for at in {0, 1, size // 2 - 1, size // 2, size // 2 + 1, size - 2, size - 1, *r.sample(range(size), 6)}:
            words |= {base, base[:at] + base[at + 1 :], base[:at] + r.choice("xyz") + base[at + 1 :], base[:at] + r.choice("abx") + base[at:]}
    df = stage(spark.createDataFrame([(w, 1) for w in words], "word string, n bigint"), "words")
    found = [tuple(x) for x in variants.neighbours(df).collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_neighbours(words)


def test_forms_and_roots(spark):
    rows = [("colouring", 5000), ("coloring", 500), ("colorin", 50), ("colorim", 5), ("colorinx", 5), ("colourinx", 5), ("lonesome", 3), ("colourinh", 490), ("colourini", 5)]
    df = stage(spark.createDataFrame(rows, "word string, n bigint"), "words")
    found = {x.word: (x.form, x.root, x.n_near, x.form_n) for x in variants.with_forms(df).collect()}
    assert found["colorim"] == ("colorin", "colouring", 1, 50)
    assert found["colorinx"] == ("coloring", "colouring", 3, 500)
    assert found["coloring"] == ("colouring", "colouring", 3, 5000)
    assert found["colouring"] == (None, "colouring", 4, None)
    assert found["lonesome"] == (None, "lonesome", 0, None)


def test_word_counts(spark, odd_documents):
    want = Counter()
    for row in odd_documents.collect():
        for word in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            word = word.translate(LOWER)
            hash_ = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{word}".encode())
            if hash_ % 31 == 0:
                word = word[: hash_ % len(word)] + word[hash_ % len(word) + 1 :]
            want[word] += 1
    assert {r.word: r.n for r in variants.word_counts(odd_documents).collect()} == want


# Shingle links


def plain_components(docs):
    sets = {}
    for id_, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[id_] = set(zip(words, words[1:], words[2:])) if len(words) >= 3 else {tuple(words)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                links += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in sets}, links


@pytest.mark.parametrize("chunk", [jaccard.CHUNK, 7])
def test_shingle_links(spark, chunk, monkeypatch):
    """Groups of copies with few words changed, one of them large; the links at and beside the limit decide."""
    monkeypatch.setattr(jaccard, "MOST_CHUNK", chunk)
    r = random.Random(3)
    word = lambda: f"{r.choice('abcdefgh')}{r.randrange(300)}"
    passage = [word() for _ in range(60)]
    docs = []
    for size, copies in ((148, 90), (60, 12), (40, 12), (30, 8), (9, 6), (2000, 4), (20, 6), (3, 3), (2, 3)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, size // 25])):
                at = r.randrange(len(text) or 1)
                text[at : at + r.choice([1, 1, 0, 2])] = [word()] * r.choice([1, 1, 0])
            docs.append(text)
    docs += [[word() for _ in range(40)] + passage + [word() for _ in range(r.randrange(40))] for _ in range(40)]
    rows = [(i * 7 % 1009, (" " if i % 3 else "\n").join(t).title() if i % 4 else " ".join(t)) for i, t in enumerate(docs)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two")]
    want, links = plain_components(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert links > 300
    assert {tuple(x) for x in jaccard.grouped(df, chunk=chunk).collect()} == want


def test_sparse_counts_are_read_back():
    r = np.random.default_rng(8)
    for share in (0.0001, 0.3, 1):
        counts = (r.integers(1, 256, 100_000) * (r.random(100_000) < share)).astype(np.uint8)
        at, some = jaccard.unpacked(jaccard.sparse(counts))
        again = np.zeros(100_000, np.uint64)
        again[at] = some
        assert (again == counts).all()


def test_parities_never_exclude_a_link():
    r = np.random.default_rng(6)
    alone = 0
    for _ in range(300):
        base = r.integers(0, 2**63, int(r.integers(1, 300))).astype(np.uint64)
        sets = [np.unique(np.append(base[int(r.integers(0, len(base) // 8 + 1)) :], r.integers(0, 2**63, int(r.integers(0, 12))).astype(np.uint64))) for _ in range(5)]
        sides = r.integers(0, 2, 5) if r.random() < 0.5 else None
        found = jaccard.alike(np.array([len(s) for s in sets]), [jaccard.parities(s) for s in sets], sides, 90)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if (sides is None or sides[i] != sides[j]) and 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
                    assert found[i] == found[j]
        alone += len(set(found.tolist()))
    assert alone > 600


def test_prefixes_share_a_token_under_any_order():
    r = np.random.default_rng(4)
    classes = r.integers(0, 9, 1 << 18).astype(np.uint8)
    for _ in range(400):
        n = int(r.integers(1, 120))
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.append(a[int(r.integers(0, n // 10 + 1)) :], r.integers(0, 2**63, int(r.integers(0, n // 10 + 1))).astype(np.uint64))
        both = len(np.intersect1d(a, b))
        a, b = sorted((np.unique(a), np.unique(b)), key=len)
        for order in range(jaccard.ORDERS):
            first = [set(s[np.argsort(jaccard.ranks(s, classes, order))[: f(len(s), 90)]].tolist()) for s, f in ((a, jaccard.short_length), (b, jaccard.probe_length))]
            if 100 * both >= 90 * (len(a) + len(b) - both):
                assert first[0] & first[1]
