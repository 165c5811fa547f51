"""Operators that SQL cannot express, against plain versions."""


import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terrace.llm import chat, components, decontaminate, licenses, lines, quality, queries, sequences, shards, simhash, token_rows, toxicity
from terrace.staging import stage

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def reference_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


# Chat


def test_chat_round_trip(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    nasty = [r"<\s> </s> <\\/s>[INST]", "[/INST] ", "<|image|>", "<", "/s>", "\\", "a\nb", None, ""]
    rows = []
    for conv in range(6):
        for turn in range(8):
            r = random.Random(conv * 100 + turn)
            parts = [("text", r.choice(nasty), None, None, None, None, None) for _ in range(r.randrange(3))]
            parts += [("image", None, f"i{turn}", 57, 28, None, None), ("audio", None, "a", None, None, 1.5, None), ("text", r.choice(nasty), *[None] * 5)]
            rows.append((conv, None if turn == 0 else turn, r.choice(["user", "assistant", "tool\\n\nx", None, "</s>"]), parts))
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{part}>")
    found = chat.formatted(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    for row in found:
        given = [r for r in rows if r[0] == row.conv_id]
        shown = lambda p: {"image": "<|image|>", "audio": "<|audio|>"}.get(p[0], p[1] or "")
        expected = [(role or "", [shown(p) for p in parts]) for _, _, role, parts in given]
        # Placeholders and texts that look like them differ in the markup only.
        assert [(t.role, t.text) for t in row.turns] == [(role, "".join(texts)) for role, texts in expected]
        masked = "".join(row.formatted[s.start : s.start + s.length] for s in row.loss_spans)
        back = re.sub(r"([<\[])\\(\\*)(/?s>|/?INST\]|\|(?:image|audio|document)\|>)", r"\1\2\3", masked)
        assert back == "".join("".join(texts) for role, texts in expected if role == "assistant")
        assert [a.ref for a in row.attachments] == [p[2] for _, _, _, parts in given for p in parts if p[2]]
        assert row.attachment_tokens == len(given) * (3 * 1 + 38)
        assert row.formatted.count("<|image|>") == len(given)


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<|image|>", "<|audio|>", "<|document|>", r"<\s>", r"[\\/INST]", " [/INST]"]


def test_control_strings_in_pieces(spark):
    """Every control string cut into two and three text parts, for both kinds of turns, with an attachment or none behind it."""
    none = [None] * 5
    rows = []
    for string in CONTROLS:
        cuts = [(i, j) for i in range(len(string) + 1) for j in range(i, len(string) + 1)]
        for i, j in cuts:
            texts = [f"a {string[:i]}", string[i:j], f"{string[j:]} b"]
            parts = [("text", t, *none) for t in texts]
            for role in ("user", "assistant"):
                for more in ([], [("image", None, "ref", 28, 28, None, None), ("text", string[:i], *none)]):
                    rows.append((len(rows), 1, role, parts + more, "".join(texts), "<|image|>" + string[:i] if more else ""))
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{part}>, said string, shown string")
    found = chat.formatted(df).withColumns({"turns": chat.read_back(F.col("formatted")), "learnt": chat.under_mask(F.col("formatted"), F.col("loss_spans"))})
    for row in found.collect():
        _, _, role, parts, said, shown = rows[row.conv_id]
        assert [(t.role, t.text) for t in row.turns] == [(role, said + shown)], parts
        assert row.learnt == (said + shown if role == "assistant" else "")
        assert row.formatted.count("<|image|>") == len(row.attachments) == (1 if shown else 0)


def test_odd_conversations(spark):
    """NULL ids, repeated rows, a long text, clashing further columns, and no rows."""
    long_ = "</s> é [/INST] <" * 40_000
    rows = [(None, 1, "user", "a"), (None, 1, "user", "a"), (None, None, None, None), (1, 1, "assistant", long_), (1, 1, "assistant", long_), (1, None, "user", "")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = given.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"), *(F.lit(1).alias(c) for c in ("alone", "body", "piece", "place", "start", "span", "turns")))
    found = chat.formatted(df).withColumns({"turns": chat.read_back(F.col("formatted")), "learnt": chat.under_mask(F.col("formatted"), F.col("loss_spans"))})
    got = sorted(((r.conv_id, r.n_turns, [(t.role, t.text) for t in r.turns], r.learnt) for r in found.collect()), key=repr)
    alone = (None, 1, [("user", "a")], "")
    assert got == sorted([alone, alone, (None, 1, [("", "")], ""), (1, 3, [("user", ""), ("assistant", long_), ("assistant", long_)], long_ * 2)], key=repr)
    assert chat.formatted(df.limit(0)).collect() == []


# Token rows and sequences


def test_token_rows_are_lossless(documents):
    tokenizer = reference_tokenizer()
    expected = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0] for r in documents.collect()}
    pieces, held = defaultdict(list), 0
    rows = token_rows.rows(documents, block=1 << 18).collect()
    for row in rows:
        ids, positions = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.position_ids, "<u4")
        assert len(ids) == len(positions) == 2048 and row.segment_ends[-1] == row.n_tokens
        for doc, start, a, b in zip(row.doc_ids, row.starts, row.segment_ends, row.segment_ends[1:]):
            pieces[doc].append((start, ids[a:b].tolist()))
            assert positions[a:b].tolist() == list(range(b - a))
        held += row.n_tokens
    assert {d: [i for _, part in sorted(p) for i in part] for d, p in pieces.items()} == expected
    assert len(rows) <= 1.02 * held / 2048 + 5
    assert len({r.row_id for r in rows}) == len(rows)


def test_added_tokens_are_one_id(spark):
    """Against the vocabulary as it is, without any setting."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"x  {end}\n\n {end}s é中", f"a\n {end[:-1]} {end[1:]}", f"don't{end}'t", f" {end} " * 700, "none", ""]
    expected = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert expected[0] == [64, 220, 50256, 275, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    pieces = defaultdict(list)
    for row in token_rows.rows(docs).collect():
        ids = np.frombuffer(row.ids, "<u2")
        for doc, start, a, b in zip(row.doc_ids, row.starts, row.segment_ends, row.segment_ends[1:]):
            pieces[doc].append((start, ids[a:b].tolist()))
    assert {d: [i for _, part in sorted(p) for i in part] for d, p in pieces.items()} == expected
    for r in sequences.packed(docs).collect():
        ids = np.array(expected[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.length, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_best_fit_takes_the_smallest_space():
    r = random.Random(3)
    lengths = [r.randrange(1, 101) for _ in range(2000)]
    free: list[int] = []
    rows: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(f, j) for j, f in enumerate(free) if f >= lengths[i]]
        if fits:
            least = min(fits)[0]
            j = max(j for f, j in fits if f == least)
            free[j] -= lengths[i]
        else:
            free.append(100 - lengths[i])
    rows = token_rows.best_fit(lengths, 100)
    assert sorted(100 - sum(lengths[i] for i in row) for row in rows) == sorted(free)
    assert sorted(i for row in rows for i in row) == list(range(len(lengths)))


def test_sequences(documents):
    tokenizer = reference_tokenizer()
    rows = sequences.packed(documents, block=300).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    for doc in documents.collect():
        ids = np.array([*tokenizer.encode(doc.text, add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[doc.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(r.length == 2048 for r in own[1:]) and sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    assert len(by_sequence) <= 1.005 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("sf, most", [("sf0.01", 482), ("sf0.1", 4936)])
def test_few_sequences(spark, sf, most):
    """What best fit by falling length needs, or one more."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert sequences.packed(docs).select("sequence_id").distinct().count() <= most


def test_few_sequences_from_several_blocks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    n, total = sequences.packed(docs, block=5000).agg(F.count_distinct("sequence_id"), F.sum("length")).first()
    assert n <= 1.001 * total / 2048 + 1


def test_sum_of_squares_takes_the_best_place():
    r = np.random.default_rng(5)
    lengths = r.integers(1, 31, 400)
    bins = sequences._place(lengths, range(len(lengths)), 30)
    gaps: list[int] = []
    for size in lengths.tolist():
        def cost(after):
            return sum(v * v for g, v in Counter(after).items() if g)
        options = [(cost(gaps[:i] + [g - size] + gaps[i + 1 :]), i) for i, g in enumerate(gaps) if g >= size]
        best = min(options)[0] if options else None
        if best is not None:
            # Any place with the same gap is as good; the smallest remaining gap wins a tie.
            i = min((gaps[i] - size, i) for c, i in options if c == best)[1]
            gaps[i] -= size
        else:
            gaps.append(30 - size)
    assert len(bins) == len(gaps)
    assert sorted(30 - sum(int(lengths[i]) for i in b) for b in bins) == sorted(gaps)


# Shards


@pytest.mark.parametrize("groups, large", [(50_000, 200_000), (100, 200), (300, 100)])
def test_shards(documents, groups, large):
    rows = shards.assigned(documents, groups=groups, large=large).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == len(texts)
    sums, slots, home = Counter(), defaultdict(list), {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert home.setdefault(data, r.shard) == r.shard
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sums) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # As near as in one block of all groups.
    assert max(sums.values()) - min(sums.values()) <= 16


def test_shards_make_up_for_a_large_group(spark):
    """One group of a twentieth of all bytes, and small ones in several blocks."""
    rows = [(i, "x" * 1000) for i in range(100)] + [(i, f"{i} " * (i % 130)) for i in range(100, 6000)]
    found = shards.assigned(spark.createDataFrame(rows, "doc_id bigint, text string"), groups=1000, large=100).collect()
    sums = Counter()
    for r in found:
        sums[r.shard] += r.size
    assert len({r.shard for r in found if r.doc_id < 100}) == 1
    assert max(sums.values()) <= 1.01 * sum(sums.values()) / 16


def test_differencing_by_hand():
    # 8 and 7 give a spread of 1, then 6, 5 and 4: the two shards of {8, 7, 6, 5, 4} end as 16 and 14.
    found = shards.differencing([[(s, 0)] for s in (8, 7, 6, 5, 4)], 2)
    sums = Counter()
    for size, to in zip((8, 7, 6, 5, 4), found):
        sums[to[0]] += size
    assert sorted(sums.values()) == [14, 16]


# Licences


def test_license_spellings(spark):
    mit = licenses.KNOWN["MIT"][0]
    variant = "The MIT Licence (MIT)\n\nCopyright (c) 2019-2021 A. Person\nAll rights reserved.\n\n" + mit.upper().replace("MERCHANTABILITY", "MERCHANTIBILITY")
    rows = [(1, variant), (2, mit + " but not quite"), (3, "first\n  released under the   MIT licence!\nlast"), (4, "Copyright 2020 X")]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id bigint, text string"), licenses.known_texts(spark)).collect()
    assert {(r.doc_id, r.line, r.license_id) for r in found} == {(1, -1, "MIT"), (2, -1, None), (3, -1, None), (3, 1, "MIT"), (4, -1, None), (1, 5, "MIT")}
    assert next(r for r in found if r.doc_id == 4).digest is None


def test_whole_texts_and_texts_inside_documents(spark):
    import textwrap

    whole = {p.stem: p.read_text() for p in licenses.TEXTS.glob("*.txt")}
    rows = [(i, f"Copyright 2020 A. Person\n\n{text}") for i, text in enumerate(whole.values())]
    mit = licenses.KNOWN["MIT"][0].replace(" The above", "\n\nThe above").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    wrapped = "\n\n".join(textwrap.fill(p, 60) for p in mit.split("\n\n"))
    bsd = "\n\n".join(textwrap.fill(p, 70) for p in whole["BSD-3-Clause"].split("\n\n"))
    rows += [
        (100, f"A tool.\nIt does things.\n\n{wrapped}\n\nMore text\nof it."),
        (101, "intro\n\nThis work is licensed under\nthe GNU General Public\nLicence, version 3.\n\nend"),
        (102, f"x\ny\n \nCopyright (c) 2001 B\n\n{bsd}\n\nend"),
        (103, f"intro\n\n{wrapped} but not quite\n\nend"),
    ]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id bigint, text string"), licenses.known_texts(spark)).collect()
    known = {(r.doc_id, r.line): r.license_id for r in found if r.license_id}
    assert {d: i for (d, line), i in known.items() if line == -1} == {i: name.split("~")[0] for i, name in enumerate(whole)}
    assert {k: i for k, i in known.items() if k[0] >= 100} == {(100, 3): "MIT", (101, 2): "GPL-3.0", (102, 5): "BSD-3-Clause"}


def test_texts_beside_code(spark):
    """No blank line is needed: shebangs, comment marks, code right beside, words of a spelling on two lines."""
    apache = licenses.HEADERS["Apache-2.0"][0].replace("\n\nhttp", "\n\n    https").replace("LICENSE-2.0\n\n", "LICENSE-2.0\n\n")
    lines_ = [part for p in apache.split("\n") for part in (textwrap.wrap(p, 70) or [""])]
    mit = licenses.KNOWN["MIT"][0].replace("NONINFRINGEMENT", "NON\nINFRINGEMENT").replace("sublicense", "sub\nlicense")
    mit = mit.replace(". THE SOFTWARE", ".\n//\n//\nTHE SOFTWARE")
    bsd = (licenses.TEXTS / "BSD-2-Clause.txt").read_text().replace("COPYRIGHT HOLDER ", "COPYRIGHT\nOWNER ")
    hashed = "\n".join(f"# {x}".rstrip() for x in lines_)
    rows = [
        (1, f"#!/bin/sh\n{hashed}\nset -e\n"),
        (2, "/*\n" + "\n".join(f" * {x}" for x in lines_) + "\n */\npackage x;\nLicensed under the MIT License.\n"),
        (3, "// A tool.\n// Copyright 2020 A. Person\n" + "\n".join(f"// {x}" for x in mit.split("\n")) + "\nint main() {}"),
        (4, f"x = 1\n{bsd}\ny = 2"),
        (5, f"#!/bin/sh\n{hashed} and more\nset -e"),  # words of other text on the last line
        (6, f"before {hashed[2:]}\nend"),  # or on the first one
        (7, "a\nLicensed\nunder the MIT License.\nLicensed under the MIT\nLicense.\nLicensed under"),
        (8, "\n".join(["Licensed under the MIT License."] * 3000)),
        (9, f"# Copyright 2020 B\n{hashed}"),  # all words of the text: the whole is one, the run is not told again
    ]
    found = licenses.scanned(spark.createDataFrame(rows, "doc_id bigint, text string"), licenses.known_texts(spark)).collect()
    known = {(r.doc_id, r.line): r.license_id for r in found if r.license_id}
    assert {k: i for k, i in known.items() if k[0] != 8} == {
        (1, 1): "Apache-2.0", (2, 1): "Apache-2.0", (2, len(lines_) + 3): "MIT", (3, 2): "MIT", (4, 1): "BSD-2-Clause",
        (7, 1): "MIT", (7, 3): "MIT", (9, -1): "Apache-2.0",
    }
    assert {k for k in known if k[0] == 8} == {(8, i) for i in range(3000)} and len(found) == len(known) + 8


def test_known_licences_are_broadcast(spark):
    """Units are not shuffled, and the number of known texts is bounded."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = licenses.scanned(docs, licenses.known_texts(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
    many = spark.range(licenses.MOST_KNOWN + 1).select(F.lit("x").alias("license_id"), F.col("id").cast("string").alias("text"))
    with pytest.raises(ValueError):
        licenses.scanned(docs, many)
    assert {r.license_id for r in licenses.scanned(docs, many.limit(0)).collect()} == {None}


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r.fingerprint for r in simhash.grouped(docs).collect()}
    assert found == {r.doc_id: f"{plain_fingerprint(r.text):016x}" for r in docs.collect()}


def test_longer_tops_for_more_fingerprints(spark, monkeypatch):
    """With 32 bits at the top, groups are small where 16 bits would need pairs of chunks; the links are the same."""
    assert [simhash.blocks_for(n) for n in (0, 10**8, 10**9, 5 * 10**10, 10**12)] == [4, 4, 5, 5, 6]
    assert [(len(simhash.tops(b)[0]), simhash.tops(b)[1]) for b in (4, 5, 6)] == [(4, 16), (10, 25), (20, 31)]
    r = random.Random(12)
    shared = r.getrandbits(16) << 48  # all agree in the first 16 bits
    prints = {shared | r.getrandbits(48) for _ in range(1500)}
    for p in list(prints)[:300]:
        prints.add(p ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 5))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = stage(spark.createDataFrame(signed, "fp bigint"), "prints")
    sizes = []
    want = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    for blocks in (4, 5, 6):
        orders, width = simhash.tops(blocks)
        for moves in orders:
            assert sorted(b for low, size, _ in moves for b in range(low, low + size)) == sorted(b for _, size, to in moves for b in range(to, to + size)) == list(range(64))
        tops = Counter(sum(((p >> low) & ((1 << size) - 1)) << to for low, size, to in orders[0]) >> (64 - width) for p in prints)
        sizes.append(max(tops.values()))
        edges = {frozenset((x.a % (1 << 64), x.b % (1 << 64))) for x in simhash.links(df, blocks=blocks).collect()}
        # Each edge is a link, or joins what links connect.
        roots = {p: p for p in prints}

        def root(p):
            while roots[p] != p:
                p = roots[p]
            return p

        for found in (edges, want):
            roots = {p: p for p in prints}
            for a, b in map(tuple, found):
                roots[root(a)] = root(b)
            groups = Counter()
            for p in prints:
                groups[root(p)] += 1
            parts = sorted(tuple(sorted(p for p in prints if root(p) == g)) for g, n in groups.items() if n > 1)
            assert found is edges or parts == before
            before = parts
    assert sizes[0] > 1400 and sizes[1] < 50 and sizes[2] < 10


@pytest.mark.parametrize("chunk", [20_000, 50])
def test_trie_finds_all_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "ROWS_PER_TASK", 700)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 100)
    r = random.Random(9)
    prints = [r.getrandbits(64) for _ in range(40)]
    for _ in range(800):
        base = r.choice(prints)
        for _ in range(r.randrange(1, 6)):
            base ^= 1 << r.randrange(64)
        prints.append(base)
    prints = list(dict.fromkeys([0, *prints]))
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)] * 2
    table = stage(spark.createDataFrame(rows, "doc_id bigint, fp bigint"), "prints")
    found = {r.fp: r.component_id for r in simhash.near_duplicates(table).collect()}
    assert found == {p: top(i) for i, p in rows}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(3000), r.randrange(3000)) for _ in range(1400)] + [(i, i + 1) for i in range(5000, 5200)] + [(9000, i) for i in range(9001, 9300)]
    label: dict[int, int] = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {n: root for n, root in label.items() if n != root}


# Decontamination


def plain_leaks(documents, items):
    cut = {}
    for i, text in items:
        w = decontaminate.words(text)
        by_line = [x for x in map(decontaminate.words, text.split("\n")) if x]
        n = len(w) - (len(by_line[-1]) if len(by_line) > 1 else len(w) // 4)
        cut[i] = [[tuple(p[j : j + 5]) for j in range(max(1, len(p) - 4))] for p in (w[:n], w[n:]) if p]
    found = set()
    for d, text in documents:
        w = decontaminate.words(text)
        held = {tuple(w[j : j + k]) for k in range(1, 6) for j in range(len(w) - k + 1)}
        found |= {(d, i) for i, parts in cut.items() if all(sum(s in held for s in p) >= 0.8 * len(p) for p in parts)}
    return found


def test_leaks(spark, documents):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    given = [(r.doc_id, r.text) for r in documents.collect()]
    tests = [(r.item_id, r.text) for r in items.collect()]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, items).collect()}
    assert found == plain_leaks(given, tests) and found


def test_leaks_of_long_items_over_several_indexes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", 200)
    r = random.Random(2)
    word = lambda: "w%d" % r.randrange(2000)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([300, 61, 64, 65, 12, 3, 1])]
    docs = []
    for d in range(120):
        text = [word() for _ in range(r.randrange(0, 400))]
        if d % 2:
            at = r.randrange(len(text) + 1)
            text[at:at] = items[d % 5][1].split()
        docs.append((d, " ".join(text)))
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == plain_leaks(docs, items)


def test_leaks_anywhere_in_a_text(spark):
    """An answer key far behind the question, edits of a long item in one place, an item in pieces, and near misses."""
    r = random.Random(5)
    word = lambda: "w%d" % r.randrange(3000)
    some = lambda n: [word() for _ in range(n)]
    short, long_, lined, flat = some(40), some(300), some(30), ["the", "the", "a"] * 10 + some(9)
    items = [(1, " ".join(short)), (2, " ".join(long_)), (3, " ".join(lined) + "\n" + " ".join(some(10))), (4, " ".join(flat)), (5, "one two"), (5, "one two three four\nfive")]
    key = items[2][1].split("\n")[1].split()
    gap = lambda a, b, n: a + some(n) + b
    docs = [
        gap(short[:30], short[30:], 500),
        gap(lined, key, 300) + some(200),
        gap(key, lined, 1000),
        long_[:70] + some(38) + long_[108:],
        long_[:70] + some(60) + long_[130:],
        gap(gap(long_[:150], long_[150:225], 200), long_[225:], 200),
        some(200) + flat + some(10),
        gap(lined, key[:5], 300),
        gap(["one", "two", "three", "four"], ["five"], 400),
        short[:30] + some(500),
        some(900),
    ]
    docs = [(d, " ".join(t)) for d, t in enumerate(docs)]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    found = {(r.doc_id, r.item_id) for r in found.collect()}
    expected = set().union(*(plain_leaks(docs, [item]) for item in items))
    assert found == expected >= {(0, 1), (1, 3), (2, 3), (3, 2), (5, 2), (6, 4), (8, 5)}
    assert not {d for d, _ in found} & {4, 7, 9, 10}


def test_least_score_is_a_lower_bound():
    """Random texts that hold just enough of a question score no less."""
    r = random.Random(8)
    for _ in range(300):
        question = ["w%d" % r.randrange(r.choice([3, 20, 500])) for _ in range(r.randrange(1, 80))]
        impact = {t: r.random() * 9 for t in set(question)}
        own = decontaminate.shingles_of(question)
        places = list(range(len(own)))
        gone = int(len(own) * 0.2 + 1e-6)
        at = r.choice([0, len(own) - gone, r.randrange(len(own) - gone + 1)])
        lacking = set(places[at : at + gone]) if r.random() < 0.5 else set(r.sample(places, gone))
        held = {t for i, s in enumerate(own) if i not in lacking for t in s}
        assert sum(impact[t] for t in held) >= decontaminate.least_score(impact, question) - 1e-9


def test_blocks_by_pivots(monkeypatch):
    """The walk finds exactly the blocks whose bound reaches their threshold, and texts on a topic score few blocks."""
    r = random.Random(9)
    word = lambda topic: r.choice(["the", "of", f"c{r.randrange(30)}", f"t{topic}_{r.randrange(40)}", f"t{topic}_{r.randrange(40)}"])
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    cut = [(i, [word(i // 8) for _ in range(r.randrange(1, 60))]) for i in range(160)]
    df = Counter(t for _, q in cut for t in set(q))
    rows = [{"item_id": i, "question": q, "answer": [], "frequency": {t: df[t] for t in set(q)}} for i, q in cut]
    index = decontaminate.Index(rows, len(rows), sum(len(q) for _, q in cut) / len(cut))
    assert len(index.need) == 40
    scored, found = 0, set()
    for n in range(400):
        text = {word(r.randrange(25)) for _ in range(r.randrange(300))} if n % 2 else set(cut[n // 3][1]) | {word(n % 20) for _ in range(50)}
        bounds = Counter()
        for term, number in index.term_id.items():
            if term in text:
                bounds.update(dict(zip(index.blocks_of[number], index.maxima_of[number])))
        blocks = list(index.candidates(text))
        assert blocks == sorted(b for b, bound in bounds.items() if bound >= index.need[b] - 1e-12)
        if n % 2 == 0:
            scored += len(blocks)
            found |= {(n, i) for b in blocks for i in range(4 * b, 4 * b + 4) if index.score(i, text) is not None}
    want = {(n, i) for n in range(0, 400, 2) for i in range(160) if index.items[i][0] == n // 3}
    assert want <= found and scored < 200 * 40 / 4
    assert list(index.candidates(set())) == [] and list(decontaminate.Index([], 0, 1.0).candidates({"a"})) == []


# Toxicity


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = queries.op9_toxicity_scores(spark, sf_dir)
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.8 * sum(r.toxic for r in rows) and hits >= 0.9 * sum(r.predicted for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def some_machine():
    """With some 40 terms of double precision, and texts of them with labels."""
    r = np.random.default_rng(3)
    machine = toxicity.Machine(-0.7)
    machine.weight, machine.vector = r.normal(0, 1, toxicity.BUCKETS), r.normal(0, 1, (toxicity.BUCKETS, toxicity.FACTORS))
    machine.used[:] = True
    texts = [np.sort(r.choice(40, n, False)).astype(np.int32) for n in (1, 2, 3, 7, 30, 12)]
    return machine, texts, np.array([1, 0, 1, 0, 1, 0], np.float64)


def plain_logit(machine, text):
    """The sum over all pairs of terms, one by one."""
    x = 1 / len(text) ** 0.5
    pairs = sum(float(machine.vector[a] @ machine.vector[b]) * x * x for i, a in enumerate(text) for b in text[i + 1 :])
    return machine.bias + sum(float(machine.weight[t]) * x for t in text) + pairs


def test_scores_are_sums_over_all_pairs():
    machine, texts, _ = some_machine()
    want = [1 / (1 + np.exp(-plain_logit(machine, t))) for t in texts]
    assert machine.scores([*texts, np.zeros(0, np.int32)]) == pytest.approx([*want, 1 / (1 + np.exp(0.7))], abs=1e-5)


def test_gradients_are_differences_of_the_loss():
    machine, texts, y = some_machine()
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]

    def loss():
        p = 1 / (1 + np.exp(-np.array([plain_logit(machine, t) for t in texts])))
        return float(np.mean(np.where(y > 0, -toxicity.POSITIVE_WEIGHT * np.log(p), -np.log(1 - p))))

    def slope(values, at, h=1e-5):
        held = values[at]
        values[at] = held + h
        above = loss()
        values[at] = held - h
        below = loss()
        values[at] = held
        return (above - below) / (2 * h)

    touched, by_weight, by_vector, by_bias = machine.gradients(np.concatenate(texts), starts, ends, y)
    assert touched.tolist() == sorted({int(t) for text in texts for t in text})
    assert by_weight == pytest.approx([slope(machine.weight, t) for t in touched], abs=1e-5)
    assert by_vector.ravel() == pytest.approx([slope(machine.vector, (t, f)) for t in touched for f in range(toxicity.FACTORS)], abs=1e-5)
    machine.bias += 1e-5
    above = loss()
    machine.bias -= 2e-5
    assert by_bias == pytest.approx((above - loss()) / 2e-5, abs=1e-5)


def test_terms_to_learn_from_are_bounded(spark):
    """Rows are taken in the order of the hashes of their ids until their terms reach the bound, long texts or not."""
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(1 + i % 7 * 10))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    order = [r.doc_id for r in docs.where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    texts, taken, total = dict(rows), [], 0
    for i in order:
        if total < 400:
            taken.append(i)
        total += len(toxicity.terms_of(texts[i], {}))
    assert 0 < len(taken) < len(order)
    # The prior tells how many rows were learnt from, since none of these terms is used.
    got = toxicity._machine(toxicity.learn(docs, labels, most_terms=400))
    bad = sum(i % 2 for i in taken)
    assert not got.used.any() and got.bias == pytest.approx(float(np.log((bad + 1) / (len(taken) - bad + 10))), abs=1e-6)


def test_pairs_count_more_than_their_terms():
    """Toxic only if both terms occur: no sum of weights can say that, pairs can."""
    r = np.random.default_rng(4)
    rows = []
    for _ in range(4000):
        a, b = int(r.random() < 0.5), int(r.random() < 0.5)
        rows.append((int(a != b), [1] * a + [2] * b + [3]))
    machine = toxicity.Machine(0.0)
    machine.choose = lambda texts, labels: machine.used.__setitem__([1, 2, 3], True)
    machine.fit([np.array(t, np.int32) for _, t in rows], np.array([y for y, _ in rows], np.float32))
    scores = machine.scores([np.array(t, np.int32) for t in ([3], [1, 3], [2, 3], [1, 2, 3])])
    assert scores[0] < 0.5 < scores[1] and scores[3] < 0.5 < scores[2]


def test_terms_that_count_in_pairs_only_are_used():
    """Each of both terms is as frequent in toxic texts as in others; training chooses the terms itself."""
    r = np.random.default_rng(4)
    rows = []
    for _ in range(4000):
        a, b = int(r.random() < 0.5), int(r.random() < 0.5)
        rows.append((int(a != b), [1] * a + [2] * b + [3] + sorted(r.choice(np.arange(100, 400), 10, False).tolist())))
    machine = toxicity.trained(rows)
    assert machine.used[[1, 2]].all() and machine.used.sum() < 20
    scores = machine.scores([np.array(t, np.int32) for t in ([1, 3], [2, 3], [1, 2, 3])])
    assert min(scores[:2]) > 0.5 > scores[2]


def test_a_term_that_is_toxic_beside_another_one_is_used():
    """Alone, the mention has the share of all texts, 11 %: all of it beside the insult, none without."""
    r = np.random.default_rng(6)
    rows = []
    for _ in range(8000):
        mention, insult = r.random() < 0.25, r.random() < 0.11
        toxic = insult if mention else r.random() < 0.11
        rows.append((int(toxic), [1] * mention + [2] * insult + sorted(r.choice(np.arange(100, 400), 10, False).tolist())))
    machine = toxicity.trained(rows)
    assert machine.used[[1, 2]].all()
    scores = machine.scores([np.array(t, np.int32) for t in ([1], [2], [1, 2])])
    assert max(scores[:2]) < 0.5 < scores[2]


# Quality


def test_ablations(documents):
    ledger = quality.ledger(documents).select("failure_bits").cache()
    bits = [r.failure_bits for r in ledger.collect()]
    for r in quality.ablations(ledger).collect():
        own, rest = quality.BIT[r.rule], quality.mask(r.policy) & ~quality.BIT[r.rule]
        mask = quality.mask(r.policy)
        assert (r.n_failed, r.n_only_this, r.n_kept_without) == (
            sum(bool(b & own) for b in bits), sum(b & mask == own for b in bits), sum(not b & rest for b in bits)
        )


# Pipeline


def test_pipeline(spark):
    docs = {r.doc_id: r.text for r in quality.kept_documents(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    seen: set = set()
    cleaned = {}
    for d in sorted(docs):
        ls = docs[d].split("\n")
        solid = [i for i, x in enumerate(ls) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone, own = set(), set()
        for k in range(len(solid) - 2):
            window = tuple(ls[i] for i in solid[k : k + 3])
            if window in seen or window in own:
                gone |= set(solid[k : k + 3])
            own.add(window)
        seen |= own
        cleaned[d] = "\n".join(x for i, x in enumerate(ls) if i not in gone)
    prints = {d: plain_fingerprint(t) for d, t in cleaned.items()}
    root = {d: d for d in cleaned}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if root[a] < root[b] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[b], changed = root[a], True
    kept = [(d, t) for d, t in cleaned.items() if root[d] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d, _ in plain_leaks(kept, items)}
    tokenizer = reference_tokenizer()
    expected = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept if d not in leaked}
    found = Counter()
    for r in corpus_pipeline.run(spark, SMALL).collect():
        found[r.doc_id] += r.length
    assert found == expected
    assert leaked and len(kept) < len(docs)  # every stage had something to do


def test_components_with_a_hot_centre(spark):
    """A star whose centre is at half of all ends, a chain, and edges of their own."""
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(1000, 1040)] + [(i, i + 1) for i in range(2000, 2600, 2)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    hot = components._hot(frame.select(F.col("b").alias("hi"), F.col("a").alias("lo")), len(edges))
    assert hot == [0]
    found = {r.node: r.root for r in components.components(frame).collect()}
    expected = {b: 0 if b < 400 else 1000 if b < 2000 else a for a, b in edges}
    assert found == expected
