"""Operators against brute force on small fixtures."""

import hashlib
import itertools
import json
import random
import re
import struct
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm import bpe, components, crf, exactdup, html, license, linededup, neardup, packing, pii, quality, qualityrules
from marlstone.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu"]


def shuffled_text(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_exact_with_collisions(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "a  b", "c", "d\n e", "", "f"])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (32, 0):  # no digest at all: every look-up is a hit, and bytes decide
        norm = {i: re.sub(r"[ \t-\r]+", " ", t) for i, t in rows}
        groups = {}
        for i, n in norm.items():
            groups.setdefault(n, []).append(i)
        for r in exactdup.exact_dedup(df, digest_bytes=width).collect():
            g = groups[norm[r.doc_id]]
            assert (r.keep_id, r.group_size, r.kept) == (min(g), len(g), min(g) == r.doc_id)
            assert r.text_sha256 == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()


def brute_components(texts, percent=85):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^ \t-\r]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("short", [1, 64])
def test_near_duplicates(spark, monkeypatch, short):
    monkeypatch.setattr(neardup, "SHORT", short)
    rng = random.Random(2)
    texts = {}
    for g in range(6):
        base = shuffled_text(rng, rng.choice([4, 30, 120, 200])).split()
        for _ in range(rng.choice([1, 5, 25])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(WORDS).upper()
            texts[len(texts) * 3 + 1] = " ".join(w)
    texts[1000], texts[1001] = "", None
    want = brute_components(texts)
    got = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    rest = neardup.first_of_each(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert {r.doc_id for r in rest.collect()} == {i for i, (_, c) in want.items() if c == i}


@pytest.mark.parametrize("shingles", [64, neardup.BLOCK])
def test_full_pairs_in_blocks(spark, monkeypatch, shingles):
    # variants of one text in one long list: every linked pair of different components is found, however blocks are cut
    monkeypatch.setattr(neardup, "SHORT", 1)
    monkeypatch.setattr(neardup, "BLOCK", shingles)
    rng = random.Random(21)
    base, texts = [f"w{j}" for j in range(120)], {}
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"e{i}" if rng.random() < 0.5 else f"e{rng.randrange(4)}"
        texts[i] = " ".join(w)
    got = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 80)


def test_full_pairs_contract_groups(spark, monkeypatch):
    # a passage that many documents hold hides a group from the lists of its sketch values: stars, not a square of pairs, link it
    monkeypatch.setattr(neardup, "SHORT", 1)
    asked, confirmed = [], neardup._confirmed

    def counted(pairs, sets, percent):
        asked.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(neardup, "_confirmed", counted)
    rng = random.Random(23)
    passage, rare, texts = [f"p{j}" for j in range(200)], [f"r{j}" for j in range(12)], {}
    for i in range(120):
        texts[i] = " ".join([*passage, *(f"own{i}x{j}" for j in range(60))])
    for i in range(120, 220):
        w = [*passage, *rare]
        w[rng.randrange(200)] = f"e{i}"
        texts[i] = " ".join(w)
    got = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert sum(asked) < 2000  # all pairs of the group are 4,950


def test_near_duplicates_above_sketch(spark):
    # sets of 32 shingles inside sets of 37: the larger set's sketch may lack 5 of the 32
    rng = random.Random(12)
    texts = {}
    for i in range(40):
        w = [f"{rng.choice(WORDS)}{i}x{j}" for j in range(41)]
        texts[2 * i], texts[2 * i + 1] = " ".join(w), " ".join(w[:36])
    got = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert all(r.component_id % 2 == 0 for r in got)


def test_near_duplicates_with_shared_names(spark, monkeypatch):
    # digests of which the first half tells next to nothing: sets are told apart by all 128 bits
    whole = neardup.set_digest
    monkeypatch.setattr(neardup, "set_digest", lambda s: (whole(s)[0] % 3, whole(s)[1]))
    rng = random.Random(16)
    texts = {}
    for i in range(12):
        w = shuffled_text(rng, 60).split()
        for _ in range(3):
            texts[len(texts)] = " ".join(w)
            w[rng.randrange(60)] = "changed"
    got = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_near_duplicates_at_80(spark):
    # one change in a text takes out 5 shingles: similarities from 0.80 to 0.85, and some below
    assert (neardup.need_of(85), neardup.need_of(80)) == (17, 15)
    rng = random.Random(13)
    texts = {}
    for i in range(60):
        w = [f"{rng.choice(WORDS)}{i}x{j}" for j in range(rng.choice([36, 44, 50, 56, 60, 110, 160]))]
        texts[2 * i] = " ".join(w)
        for k in range(10, len(w) - 10, 50):
            w[k] = "changed"
        texts[2 * i + 1] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, at85 = brute_components(texts, 80), brute_components(texts)
    assert {i for i, (_, c) in want.items() if c == i} < {i for i, (_, c) in at85.items() if c == i}
    rest = corpus_pipeline.near_dedup(spark, df, "")
    assert {r.doc_id for r in rest.collect()} == {i for i, (_, c) in want.items() if c == i}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(7, 7), (None, 3)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.comp for r in got} == {x: find(x) for x in up}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def brute_lines(rows):
    """Remaining texts: a line with a word goes after an equal one, or, from NEAR_CHARS on, one within an edit."""
    seen, near, want = set(), [], {}
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            n = re.sub(r"[ \t-\r]+", " ", line.lower()).strip(" ")
            if not n or n not in seen and (len(n) < linededup.NEAR_CHARS or not any(one_edit(n, s) for s in near)):
                kept.append(line)
            if n and n not in seen:
                seen.add(n)
                near += [n] * (len(n) >= linededup.NEAR_CHARS)
        want[i] = "\n".join(kept)
    return want


def test_line_dedup(spark):
    rng = random.Random(4)
    lines = [shuffled_text(rng, 8) for _ in range(30)]

    def near(s):
        p = rng.randrange(len(s))
        return rng.choice([s[:p] + s[p + 1 :], s[:p] + "q" + s[p:], s[:p] + "q" + s[p + 1 :]])

    rows = []
    for i in range(120):
        body = [rng.choice(lines) for _ in range(3)]
        body = [near(x) if rng.random() < 0.4 else x for x in body] + ["short one", "  " + rng.choice(lines).upper() + " ", "", "x", f"short {i}", " \t "]
        rows.append((i, "\n".join(body)))
    got = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(rows)
    assert sum(r.n_near for r in got) > 50
    assert [r.doc_id for r in got if "short one" in r.text] == [0]  # short lines too, by equality


def test_line_dedup_every_place(spark):
    # every length about the bound and every place of an edit, in lines of few letters, where keys meet a lot
    rng = random.Random(14)
    rows, i = [], 0
    for n in (*range(29, 50), 97):
        for _ in range(3):
            base = "".join(rng.choice("ab") for _ in range(n))
            for p in (0, 1, n // 2 - 1, n // 2, n // 2 + 1, n - 2, n - 1, rng.randrange(n)):
                for made in (base, base[:p] + base[p + 1 :], base[:p] + "é" + base[p:], base[:p] + "c" + base[p + 1 :]):
                    if rng.random() < 0.5:
                        rows.append((i, made))
                        i += 1
    got = linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.text for r in got} == brute_lines(rows)


def test_line_dedup_long_lines(spark):
    rng = random.Random(15)
    base = "".join(rng.choice("abcdefgh ") for _ in range(200_000)).strip()
    rows = [(1, base), (2, base[:150_000] + base[150_001:]), (3, base[:5] + "é" + base[5:]), (4, base[:-9] + "zz" + base[-9:])]
    got = {r.doc_id: r.n_near for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_quality_rules(spark):
    rng = random.Random(5)
    rows = [(i, "h", shuffled_text(rng, 80) + "\n" + shuffled_text(rng, 3) + "\nmenu line here") for i in range(60)]
    rows += [(100 + i, "h", ("menu line here\nhome about contact terms\n" * 12) + shuffled_text(rng, 4)) for i in range(30)]
    rows += [(200 + i, "g", rows[0][2]) for i in range(40)]  # copies are not boilerplate
    got = {r.doc_id: r for r in qualityrules.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert all(got[i].kept for i in range(60)) and all(got[200 + i].kept for i in range(40))
    assert got[0].n_frequent_words == 3
    for i, _, t in rows:
        w = t.split()
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(grams)
        cov = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        ls = t.split("\n")
        assert (got[i].n_words, got[i].n_repeat_words, got[i].n_dup_lines) == (len(w), len(cov), len(ls) - len(set(ls)))
        assert got[i].base_failed == (len(w) < 50 or 100 * len(cov) > 50 * len(w))


def test_depleted(spark):
    # boilerplate in varied documents, each with next to nothing of its own
    menu = "\n".join(f"item number {i} of the menu" for i in range(20))
    rng = random.Random(6)
    rows = [(i, "h", f"{shuffled_text(rng, 3)}\n{shuffled_text(rng, 3)}\n{menu}") for i in range(60)]
    got = qualityrules.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert all(r.n_frequent_words == 120 and not r.kept for r in got)
    assert qualityrules.good_documents(spark.createDataFrame(rows, "doc_id long, source string, text string")).count() == 0


def test_template_pages(spark):
    # distinct documents by text: of many template lines, or of template lines alone
    rng = random.Random(11)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n))
    menu = [letters(5) for _ in range(20)]
    rows = [(i, "h", "\n".join([letters(3), *menu, letters(3)])) for i in range(60)]
    only = [letters(6) for _ in range(12)]
    rows += [(100 + i, "g", "\n".join(rng.sample(only, 12))) for i in range(60)]
    half = letters(40)  # makes up more than half of each document
    rows += [(200 + i, "f", f"{half}\n{letters(12)}") for i in range(60)]
    rows += [(300 + i, "e", "\n".join([letters(30), letters(30)])) for i in range(20)]
    rows += [(400 + i, "e", rows[-1][2]) for i in range(40)]
    got = {r.doc_id: r for r in qualityrules.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    for i, host, text in rows:
        want = {"h": 100, "g": 72, "f": 40, "e": 0}[host]
        assert (got[i].n_frequent_words, got[i].kept) == (want, want * 100 < len(text.split()) * 80)


def test_license(spark):
    rows = [
        (1, "GNU  General-Public license and Apache License; CC BY, cc by"),
        (2, "Permission is hereby granted, free of charge, to every person obtaining a copy of this software and its associated documentation files, to deal in the Software without any restriction"),
        (3, "the general public license of gnu"),
    ]
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (4, 0, 9, "apache,cc-by,gpl")
    assert got[2].labels == "mit-text" and 0.6 <= got[2].score < 1 and got[2].n_base == 0
    assert got[3].labels == "" and got[3].score == 0


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", bpe.WordCoder), ("byte_bpe_50k.json", bpe.ByteCoder)])
def test_bpe(name, kind):
    rng = random.Random(7)
    tok, coder = Tokenizer.from_file(tokenizer(name)), kind(tokenizer(name), leaf=48)
    alphabet = ["abcdef", "ABC", "0123456789", "'s't'll", ".!*#", "éÈßİΣ", "́̈", "日本", "\U0001f600‍", " ", "\n", "\t", " ", "\x1c", "<|endoftext|>"]
    texts = ["", " ", "\n", "a b", "  a\n\nb  "]
    for _ in range(400):
        sub, t = rng.sample(alphabet, rng.choice([1, 2, 4, len(alphabet)])), ""
        while len(t) < rng.choice([5, 60, 400]):
            a = rng.choice(sub)
            t += a if a[0] == "<" else "".join(rng.choice(a) for _ in range(rng.randint(1, 9 if a.strip() else 2)))
        texts.append(t)
    done = list(coder.encode_decode(texts)) if kind is bpe.WordCoder else [(x.tobytes(), None) for x in coder.encode(texts)]
    for t, (ids, text) in zip(texts, done, strict=True):
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(want)}I", *want), t
        if text is not None:
            assert text.decode() == tok.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("name,kind", [("word_bpe_49k.json", bpe.WordCoder), ("byte_bpe_50k.json", bpe.ByteCoder)])
def test_bpe_ranks(name, kind):
    # the ids that serve as ranks rebuild every token of the vocabulary from the two parts that the file merges
    tok, coder = Tokenizer.from_file(tokenizer(name)), kind(tokenizer(name))
    ranks = coder.fast._mergeable_ranks
    bytes_of = {i: t for t, i in ranks.items()}
    vocabulary = tok.get_vocab(with_added_tokens=False)
    for m in json.loads(tok.to_str())["model"]["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ", 1)
        top = vocabulary[a + b]
        if top not in bytes_of:
            continue
        parts = [bytes([x]) for x in bytes_of[top]]
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 30))
            assert ranks[parts[at] + parts[at + 1]] < top
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert parts == [bytes_of[vocabulary[a]], bytes_of[vocabulary[b]]], m


def test_bpe_every_character():
    tok, coder = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), bpe.WordCoder(tokenizer("word_bpe_49k.json"))
    chars = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = [f"a{c}{c} 1{c}b {c}" for c in chars]
    for t, e, got in zip(texts, tok.encode_batch(texts, add_special_tokens=False), coder.plain(texts), strict=True):
        assert e.ids == got, t


def test_bpe_long_runs(spark):
    # runs over a leaf go through the trees in the operator itself
    rng = random.Random(17)
    tok = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    runs = ["".join(rng.choice("abcdefghijk") for _ in range(n)) for n in (1023, 1024, 1025, 5000, 20_000)]
    runs += ["".join(rng.choice("aé1.-Σß日") for _ in range(9000)), "x" * 30_000, "ab" * 4000 + "<|endoftext|>" + "1" * 3000]
    rows = [(i, f"some words {r} and more") for i, r in enumerate(runs)] + [(100, " ".join(runs))]
    for r in bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer("word_bpe_49k.json"), ids=True).collect():
        want = tok.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_pack(real):
    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in real.collect()}
    by = {}
    for r in packing.pack(real, tokenizer("byte_bpe_50k.json")).collect():
        by.setdefault(r.doc_id, []).append(r)
    for i, t in texts.items():
        ids, at = [*tok.encode(t, add_special_tokens=False).ids, 0], 0
        for r in sorted(by[i], key=lambda r: r.start):
            piece = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, r.offset, r.length & (r.length - 1)) == (at, len(ids), 0, 0)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
            at += r.length
        assert at == len(ids)


def test_pack_buckets(real, tmp_path):
    path = tokenizer("byte_bpe_50k.json")
    key = lambda r: (-r.length, r.doc_id, r.start)
    rows = sorted(packing.pack(real, path).collect(), key=lambda r: r.sequence_id)
    assert [r.sequence_id for r in rows] == list(range(len(rows)))
    assert [key(r) for r in rows] == sorted(key(r) for r in rows) and all(1 << r.bucket == r.length for r in rows)
    # the same numbers however the input is dealt
    assert {(key(r), r.sequence_id) for r in packing.pack(real.repartition(7), path).collect()} == {(key(r), r.sequence_id) for r in rows}
    packing.write_buckets(packing.pack(real, path, ids=True), str(tmp_path / "b"))
    back = real.sparkSession.read.parquet(str(tmp_path / "b"))
    assert back.count() == len(rows) and {p.name for p in (tmp_path / "b").glob("length=*")} == {f"length={r.length}" for r in rows}


def test_pack_shuffles_texts_not_ids(spark, monkeypatch):
    path, plans = tokenizer("byte_bpe_50k.json"), []
    stored = packing.stored
    monkeypatch.setattr(packing, "stored", lambda df, *a, **k: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stored(df, *a, **k))[1])
    rows = [(7, "a b c " * 900), (7, "x y " * 1500), (None, "n"), (None, None), (3, ""), *[(9, "same text") for _ in range(40)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r.sequence_id, r.doc_id, r.start, r.length, r.ids_crc32)
    got = packing.pack(docs.repartition(3), path, ids=True).collect()
    # one table with ids, dealt before there were any
    assert len(plans) == 1 and plans[0].index("MapInArrow") < plans[0].index("RepartitionByExpression")
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by_number = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in by_number] == sorted((r.length for r in got), reverse=True)
    assert all([r.doc_id or 0 for r in by_number if r.length == n] == sorted(r.doc_id or 0 for r in got if r.length == n) for n in {r.length for r in got})
    assert sorted(map(str, map(key, packing.pack(docs, path).collect()))) == sorted(map(str, map(key, got)))


def test_pii_base():
    rng = random.Random(8)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def brute(t):
        out = [("email", *m.span()) for m in email.finditer(t)] + [("ip", *m.span()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in card.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if 16 <= len(d) <= 19 and pii.luhn(d):
                out.append(("card", *m.span()))
        return out + [("phone", *m.span()) for m in phone.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]

    for _ in range(4000):
        t = "".join(rng.choice("a@.1-+ 2(5%x") for _ in range(rng.randint(1, 60)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_method(spark):
    text = 'token = "1eb9c654e721b4f812088970e66a6345cee33dd7" and a.b@c.de, see version 2.0.'
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    at = text.index("1eb9")
    assert r.spans == f"email:55:63,secret:{at}:{at + 40}" and r.n_email == 1
    assert r.base_sha256 == hashlib.sha256(b"email:55:63").hexdigest()
    assert pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text == 'token = "[SECRET]" and [EMAIL], see version 2.0.'


def test_html():
    page = '<nav>Home</nav><div class="ad">Buy</div><article><h1>A &amp; B</h1><p>one  two<br>three <b>fo</b>ur</p><aside>no</aside><p>five</article><div class="comments"><p>no</p></div><footer>no</footer>'
    assert html.main_text(page) == "A & B one two three four five"
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>var t = '</p>';</script>") == ""
    assert html.main_text("just words") == "just words"


def test_html_layout_names():
    story = "<h1>Title</h1><p>one two</p><p>three four</p>"
    page = f'<body class="single no-sidebar comments-open"><div class="has-sidebar with-banner"><nav>Home</nav><article>{story}</article><div class="sidebar"><p>side</p></div></div></body>'
    assert html.main_text(page) == "Title one two three four"
    page = f'<body><main><article><header><h1>Head</h1></header>{story}<footer>Filed</footer></article><section class="comments"><article class="comment"><p>a reader</p></article></section></main></body>'
    assert html.main_text(page) == "Head Title one two three four"
    assert html.main_text("<body><div>just <b>words</b><br>here</div></body>") == "just words here"


def test_html_labelled_pages():
    # every piece of the labelled pages falls on its side
    for page in html.LABELLED:
        for kind, text, context, main in html.parts(page):
            if kind == "t" and text.strip():
                assert (html._context_score(context) > 0) == main, text


def brute_region(scores):
    """(sum, first block, last block and one) of the best run of (words, score, tag) blocks; the first of equals."""
    best = (0.0, 0, 0)
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j][0] * scores[j][1] + (scores[j][2] if j > i else 0.0)
            if total > best[0] + 1e-9:
                best = (total, i, j + 1)
    return best


def test_html_against_all_regions():
    rng = random.Random(19)
    _, tags, _ = html.trained()
    elements = ["p", "h2", 'div class="ad"', "nav", 'div class="content"', "li", "aside", "footer", "section"]
    for _ in range(300):
        page, blocks = "", []
        for k in range(rng.randint(1, 12)):
            e = rng.choice(elements)
            ws = [f"w{k}x{i}" for i in range(rng.randint(1, 9))]
            page += f"<{e}>{' '.join(ws)}</{e.split()[0]}>"
            name = e.split()[0]
            context = frozenset(f for f in html._features(name, e[len(name) :], False)[0] if f in html._known())
            # one tag opens the block, one closed the one before
            tag = tags.get(name, -0.05) + (tags.get(blocks[-1][3], -0.05) if blocks else 0.0)
            blocks.append((len(ws), html._context_score(context), tag, name, ws))
        _, i, j = brute_region([b[:3] for b in blocks])
        assert html.main_text(page).split() == [w for b in blocks[i:j] if b[1] > 0 for w in b[4]], page


@pytest.mark.parametrize("part", ["<div>", '<a "', '<a href="', '<a b="', "<p class='", "<", "</", "<!--", "<div class=x", "<ul><li>", "<script>", "<div></p>"])
def test_html_hostile(part):
    for page in (part * 20_000, part * 20_000 + "='>", "<p>text</p>" + part * 20_000 + "word"):
        began = time.process_time()
        html.main_text(page)
        assert time.process_time() - began < 2


def test_quality(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = [r for r in quality.classify(docs, labels).collect() if r.held_out and r.doc_id in known]
    assert len(got) > 40 and sum(r.predicted == known[r.doc_id] for r in got) >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_crf_against_enumeration():
    rng = np.random.default_rng(3)
    for _ in range(20):
        k, sizes = 3, [int(n) for n in rng.integers(1, 6, 4)]
        parts = [rng.normal(size=(n, k)) * 2 for n in sizes]
        trans, start = rng.normal(size=(k, k)), rng.normal(size=k)
        emit, lengths = crf.padded(parts)
        logz, single, pair = crf.marginals(emit, lengths, trans, start)
        best, want_pair = crf.viterbi(emit, lengths, trans, start), np.zeros((k, k))
        for d, (n, e) in enumerate(zip(sizes, parts, strict=True)):
            paths = list(itertools.product(range(k), repeat=n))
            score = np.array([start[p[0]] + sum(e[i, y] for i, y in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
            weight = np.exp(score - score.max())
            weight /= weight.sum()
            assert np.isclose(logz[d], score.max() + np.log(np.exp(score - score.max()).sum()))
            for i in range(n):
                assert np.allclose(single[d, i], [weight[[p[i] == y for p in paths]].sum() for y in range(k)])
            for w, p in zip(weight, paths, strict=True):
                for a, b in zip(p, p[1:]):
                    want_pair[a, b] += w
            assert tuple(best[d, :n]) == paths[int(score.argmax())]
        assert np.allclose(pair, want_pair)


def test_pii_chain_parts_exactly():
    # the stretches between certain tokens give what one Viterbi over the whole chain gives
    rng = random.Random(18)
    t = pii.Tagger(*pii.trained())
    pieces = [w for line in pii.LABELLED for w in re.sub(r"\[\w+:|\]", " ", line).split()] + ["hunter2", "555-1234", "0532", "AB12"]
    texts = [pii._TOKEN.findall(" ".join(rng.choice(pieces) for _ in range(rng.choice([1, 2, 5, 40, 300])))) for _ in range(120)] + [[]]
    got = t.labels(texts)
    parted = 0
    for tokens, labels in zip(texts, got, strict=True):
        if not tokens:
            assert labels == []
            continue
        e, begins = t.scores([tokens])
        parted += int(t.certain(e)[begins[0] : begins[0] + len(tokens)].sum())
        e = e[begins[0] : begins[0] + len(tokens)].astype(float)
        whole = crf.viterbi(e[None], np.array([len(tokens)]), t.trans, t.start)[0]
        assert labels == [(i, int(y)) for i, y in enumerate(whole) if y]
    assert parted > 1000


def test_pii_hostile():
    model = pii.trained()
    texts = [" ".join(map(str, range(20_000))), *(["word"] * 499), "a1" * 300_000, "=" * 100_000, "x@" * 50_000]
    began = time.time()
    done = list(pii._spans(texts, pii.Tagger(*model)))
    assert len(done) == len(texts) and time.time() - began < 30
    small = pii.Tagger(*model)
    small.ROWS = 5  # a tagger that starts anew all the time finds the same
    for t in ("password = hunterhunter", "IBAN DE89 3704 0044 0532 0130 00 bitte", "password hunter2hunter2x9", "the secret of it"):
        assert list(pii._spans([t], small)) == list(pii._spans([t], pii.Tagger(*model)))


@pytest.mark.parametrize(
    "text,want",
    [
        ("password hunter2hunter2x9", "secret:9:25"),
        ("IBAN DE89 3704 0044 0532 0130 00 bitte", "account:5:32"),
        ("password = hunterhunter", "secret:11:23"),
        ("secret: correcthorse", "secret:8:20"),
        ("call me at (415) 555-2671 now", "phone:12:25"),
        ("the secret of the house is a key", ""),
        ("api_key=" + "k9Qx" * 60, "secret:8:248"),  # seen from end to end
    ],
)
def test_pii_spans(text, want):
    ((base, own),) = pii._spans([text], pii.Tagger(*pii.trained()))
    assert pii._joined(pii._all(base, own)) == want
