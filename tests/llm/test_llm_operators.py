"""Operators against brute force on small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import resource
import sys
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from footfall.llm import attribution, common, fixity, hilbert, jaccard_join, mixing, packing, pii, quality_rules, spotsigs
from footfall.llm import shingles as shingles_module
from footfall.llm import token_files, tokens
from footfall.llm.common import WORDS, with_running_total
from footfall.llm.components import components
from footfall.llm.shingles import shingle_sets
from footfall.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORD_PARTS = public_tokenizers.path("word_bpe_49k.json")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, ids=None):
    rows = [(i, t) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def shingles(text, width):
    words = WORDS.findall((text or "").translate(FOLD))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_shingle_sets_equal_brute_force():
    texts = ["a b c d", "", None, "A b\tC", "x", "x y", "a b c d a b c d", "é à ü z", "  lead  trail ", "a b c"]
    values, at = shingle_sets(pa.array(texts), 3)
    found = [set(values[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]
    for (i, a), (j, b) in itertools.product(enumerate(texts), repeat=2):
        assert len(found[i] & found[j]) == len(shingles(a, 3) & shingles(b, 3))
    part, _ = shingle_sets(pa.array(texts).slice(3), 3)
    assert (part == values[at[3] :]).all()


def near_copies(seed):
    """Texts with exact copies, near copies of several degrees, and a passage that a third of them share."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = " ".join(r.choices(words, k=40))
    texts = []
    for _ in range(25):
        base = r.choices(words, k=r.randint(30, 120))
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(" ".join(copy))
    texts = [t + " " + passage if i % 3 == 0 else t for i, t in enumerate(texts)]
    return texts + [texts[0]] * 20 + [texts[0].upper(), "", None, "one", "two words", "two words"]


def brute_components(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize("hot, width, percent", [(32, 3, 90), (2, 3, 90), (4, 5, 80)])
def test_components_equal_brute_force(spark, monkeypatch, hot, width, percent):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    texts = near_copies(hot)
    found = jaccard_join.jaccard_components(documents(spark, texts).repartition(5), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(texts, width, percent)


def test_one_of_each_whatever_the_splits(spark):
    texts = [t for t in near_copies(3) if t]
    path = scratch_path(spark, "docs")
    documents(spark, texts).repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    found = jaccard_join.one_of_each(docs, 5, 80)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "1")  # as if cores were lost before the last scan
        kept = sorted(r.doc_id for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert kept == sorted({root for _, root in brute_components(texts, 5, 80).values()})


def test_one_of_each_of_stored_rows_copies_no_text(spark, monkeypatch):
    texts = [t for t in near_copies(3) if t]
    path = scratch_path(spark, "docs")
    docs = documents(spark, texts).union(documents(spark, texts[:9])).withColumn("place", F.lit("own"))
    docs.repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    expected = sorted(jaccard_join.one_of_each(docs, 5, 80).collect())
    columns, store = {}, jaccard_join.Tables.store

    def noted(self, df, label):
        columns[label] = dict(df.dtypes)
        return store(self, df, label)

    monkeypatch.setattr(jaccard_join.Tables, "store", noted)
    assert sorted(jaccard_join.one_of_each(docs, 5, 80, stored=True).collect()) == expected
    assert not any("row" in c or "text" in c for c in columns.values())
    # What most of the disk goes to names groups by numbers, not digests.
    assert columns["postings"] == {"token": "bigint", "group": "bigint", "n": "bigint", "pos": "int", "spos": "int"}


def test_postings_drop_rare_tokens_of_one_group(spark):
    rows = [(1, 20, [5, 6, 9], 2), (2, 21, [7, 6, 8], 2), (3, 22, [4], 1)]
    reps = spark.createDataFrame(rows, "class long, n long, prefix array<long>, rare long")
    found = {tuple(r) for r in jaccard_join._postings(reps).collect()}
    assert found == {(6, 1, 20, 2, 1), (9, 1, 20, 3, 2), (6, 2, 21, 2, 1), (8, 2, 21, 3, 2)}


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100 + (i * 7 + 3) % 40) for i in range(40)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and all(found[i] >= 100 for i in range(100, 140))
    assert all(found[a] == found[b] for a, b in links)


def test_mix_comes_near_its_targets(spark):
    r = random.Random(3)
    rows = [(i, "w " * min(3000, int(r.paretovariate(0.9) * 5)), f"s{min(i % 9, 3)}" if i % 11 else None) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = mixing.report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    total = sum(x.size for x in found)
    by = {}
    for x in found:
        assert x.taken % max(x.size, 1) == 0 and x.taken <= 2 * x.size
        size, taken, target = by.get(x.source, (0, 0, 0))
        by[x.source] = (size + x.size, taken + x.taken, x.target)
    assert abs(sum(t for *_, t in by.values()) - 1.5 * total) < 1e-6 * total
    for size, taken, target in by.values():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= 0.02 * target + 1
    open_ = [t for s, _, t in by.values() if t < 2 * s - 1e-6]
    assert max(open_) / min(open_) in (pytest.approx(1), pytest.approx(2), pytest.approx(2.5), pytest.approx(5))
    again = {x.doc_id: x.taken for x in mixing.report(docs.repartition(7)).collect()}
    assert again == {x.doc_id: x.taken for x in found}


def test_fullest_combination_equals_brute_force():
    r = random.Random(1)
    for _ in range(300):
        counts = {length: r.randint(1, 3) for length in r.sample(range(1, 40), r.randint(1, 5))}
        room = r.randint(0, 60)
        every = [x for length, n in counts.items() for x in [length] * n]
        best = max(sum(c) for k in range(len(every) + 1) for c in itertools.combinations(every, k) if sum(c) <= room)
        found = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(found) == best and all(found.count(x) <= counts[x] for x in found)


def test_packing_is_gapless_and_near_the_bound():
    r = random.Random(2)
    lengths = [min(4096, int(r.lognormvariate(5.5, 1.2)) + 1) for _ in range(6000)]
    bins, offsets = packing.pack(lengths)
    held = {}
    for b, o, n in sorted(zip(bins, offsets, lengths)):
        assert o == held.get(b, 0)
        held[b] = o + n
    assert max(held.values()) <= 4096 and len(held) <= -(-sum(lengths) // 4096) + 1


def test_packed_ids_are_the_tokenizers(spark):
    texts = ["Hello  world", "", None, "tabs\tand\n\nlines ", " x" * 9000, "<|endoftext|> naïve É", "a<|startoftext|>b <|endoftext|>"]
    coder = Tokenizer.from_file(WORD_PARTS)
    rows = packing.packed(documents(spark, texts), WORD_PARTS).collect()
    for i, text in enumerate(texts):
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted((x.piece, x.start, x.length, x.ids_crc32) for x in rows if x.doc_id == i)
        cuts = range(0, len(ids), 4096)
        assert mine == [(k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(cuts)]


def test_token_files_round_trip_and_lookup(spark):
    texts = [f"document {i} says  {'again ' * (i % 7)}\n" for i in range(300)] + [None, ""]
    coder = Tokenizer.from_file(BYTES)
    folder = scratch_path(spark, "files")
    token_files.write(documents(spark, texts).repartition(6), folder, BYTES)
    found = {r.key: r for r in token_files.documents(spark, folder).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    one = token_files.lookup(spark, folder, 123).collect()
    assert [coder.decode(r.ids[:-1]) for r in one] == [texts[123]]
    blocks = spark.read.parquet(f"{folder}/blocks").withColumn("dictionary", F.lit("other"))
    blocks.write.parquet(f"{folder}_x/blocks")
    spark.read.parquet(f"{folder}/dictionary").write.parquet(f"{folder}_x/dictionary")
    with pytest.raises(Exception, match="needs dictionary"):
        token_files.documents(spark, f"{folder}_x").collect()


def test_a_key_of_a_third_of_all_rows_is_spread(spark):
    texts = [f"text {i}" for i in range(600)] + ["the same"] * 300
    ids = [*range(300), *[300] * 200, *[None] * 100, *[7] * 300]
    folder = scratch_path(spark, "files")
    token_files.write(documents(spark, texts, ids).repartition(4), folder, BYTES)
    blocks = spark.read.parquet(f"{folder}/blocks").select("part", F.size("keys").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    assert max(r.n for r in blocks.collect()) < 200
    held = sorted(((r.start, r.key, r.n_tokens) for r in token_files.documents(spark, folder).collect()), key=lambda x: x[0])
    assert [k for _, k, _ in held] == sorted(ids, key=lambda k: (k is not None, k or 0))
    assert all(a[0] + a[2] == b[0] for a, b in zip(held, held[1:]))
    assert token_files.lookup(spark, folder, 7).count() == 301


def test_lookup_beside_null_keys(spark):
    texts, ids = ["nobody's", "also nobody's", "one", "two", "two again"], [None, None, 1, 2, 2]
    coder = Tokenizer.from_file(BYTES)
    folder = scratch_path(spark, "files")
    token_files.write(documents(spark, texts, ids).coalesce(1), folder, BYTES)
    for key in (None, 1, 2, 3):
        found = sorted(coder.decode(r.ids[:-1]) for r in token_files.lookup(spark, folder, key).collect())
        assert found == sorted(t for i, t in zip(ids, texts) if i == key)


@pytest.mark.parametrize("path", [BYTES, WORD_PARTS])
def test_special_tokens_in_texts_are_the_tokenizers(path):
    coder = Tokenizer.from_file(path)
    parts = [*coder.get_vocab(with_added_tokens=True).keys() - coder.get_vocab(with_added_tokens=False).keys()]
    parts = sorted({*parts, "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"}) + [" ", " ", " ", "a", "Bc", "1", "!", "\n", "é", "\0"]
    r = random.Random(2)
    texts = ["".join(r.choices(parts, k=r.randint(0, 12))) for _ in range(3000)]
    mine = tokens.encoder(tokens.vocabulary(path))
    for text, coded in zip(texts, mine.encode(texts)):
        assert mine.ids(coded).tolist() == coder.encode(text, add_special_tokens=False).ids, text


def test_token_files_and_sections_with_special_tokens(spark):
    texts = ["one <|endoftext|> two", "<|endoftext|>", "x"]
    coder = Tokenizer.from_file(BYTES)
    folder = scratch_path(spark, "files")
    token_files.write(documents(spark, texts), folder, BYTES)
    found = {r.key: r for r in token_files.documents(spark, folder).collect()}
    rows = attribution.attributed(documents(spark, texts), BYTES, ("text",)).collect()
    for i, text in enumerate(texts):
        ids = coder.encode(text, add_special_tokens=False).ids
        assert found[i].ids_crc32 == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
        assert [r.n_tokens for r in rows if r.doc_id == i] == [len(ids)]


def pii_texts(n):
    r = random.Random(5)

    def card():
        head = [r.randint(0, 9) for _ in range(15)]
        return next(c for k in range(10) if pii.luhn(c := "".join(map(str, [*head, k]))))

    make = {
        "phone": lambda: f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
        "card": card,
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "email": lambda: f"user.{r.randint(1, 99)}@mail{r.randint(0, 9)}.example.com",
    }
    texts = []
    for i in range(n):
        kind = list(make)[i % 4]
        texts.append(f"words before {make[kind]()} and version {r.randint(1, 9)}.{r.randint(0, 9)} or {r.randbytes(6).hex()} after")
    return texts, make


def test_the_random_field_adds_what_the_patterns_miss():
    texts, make = pii_texts(120)
    model = pii.trained(texts)
    phone, card = make["phone"](), make["card"]()
    base, every = pii.find(f"call {phone} {card} now", model)
    assert base == [] and [k for k, *_ in every] == ["card", "phone"]
    for text in texts:
        base, every = pii.find(text, model)
        assert base == every and len(base) == 1
    clean = "In 2019 we sold 30,000 units of version 4.0.1 at 17:30"
    assert pii.find(clean, model) == ([], [])
    assert pii.find("", model) == ([], []) and pii.find("mail a@b", pii.SemiMarkov())[1] == []


CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def contract_spans(text):
    """Base spans straight from the four patterns and their checks."""
    out = []
    for kind, pattern in CONTRACT.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
            if (
                kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_contract():
    r = random.Random(12)
    parts = ["1.2.3.4", "300.1.1.1", "+1 ", "(555) ", "4111 1111 1111 1111", "4111111111111111", "a.b", "@", "x-y.org", ".", "..", " ", "-", "é", "٣", "12", "7", "+", "%", "\n"]
    for _ in range(20000):
        text = "".join(r.choices(parts, k=r.randint(1, 12)))
        assert pii.base_spans(text)[0] == contract_spans(text), text


def test_numbers_that_fail_their_check_stay():
    texts, make = pii_texts(300)
    r = random.Random(13)

    def wrong():
        number = make["card"]()
        return number[:-1] + str((int(number[-1]) + r.randint(1, 9)) % 10)

    model = pii.trained(texts + [f"order {wrong()} of 2019" for _ in range(100)])
    for _ in range(300):
        assert pii.find(f"order {wrong()} and {r.randint(256, 999)}.1.2.3", model) == ([], [])
    found = 0
    for _ in range(200):
        a, b = make["card"](), make["card"]()
        base, every = pii.find(f"cards {a} {b} here", model)
        found += base == [] and [x[0] for x in every] == ["card", "card"]
    assert found >= 190


@pytest.mark.parametrize(
    "text",
    [
        " ".join(str(i * 7919 % 100_003) for i in range(170_000)), "4111111111111111 " * 60_000, "+1 555 1234567 " * 60_000,
        "1.2.3.4 5" * 100_000, "9" * 1_000_000, "a" * 500_000 + "@" + "b" * 500_000, "@." * 400_000, "1 2 " * 250_000,
    ],
)
def test_a_million_characters_of_numbers(text):
    model = pii.trained(pii_texts(60)[0])
    start, before = time.process_time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    base, every = pii.find(text, model)
    assert time.process_time() - start < 60
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10
    assert set(base) <= set(every)


def test_every_kind_in_the_corpus_has_examples(spark, monkeypatch):
    texts, _ = pii_texts(12)
    plain = [f"item {i * 7919 % 1000} of lot {i}" for i in range(6000)]
    docs = spark.createDataFrame([(t,) for t in plain + plain[:1] * 3000 + texts], "text string").repartition(8)
    monkeypatch.setattr(pii, "trained", list)
    sample = pii.learn(docs)
    assert {kind for t in sample for kind, *_ in pii.base_spans(t)[0]} == set(pii.KINDS)
    assert len(sample) == len(set(sample)) == pii.SAMPLE


def test_the_best_segmentation_equals_brute_force():
    r = random.Random(4)
    for _ in range(40):
        n = r.randint(1, 6)
        segments = [(i, j, [f"f{i}{j}"]) for i in range(n) for j in range(i + 1, n + 1) if r.random() < 0.5]
        model = pii.SemiMarkov()
        model.weights = {(k, f[0]): r.uniform(-2, 2) for _, _, f in segments for k in pii.KINDS}
        model.weights |= {(a, ">" + b): r.uniform(-1, 1) for a in ("", *pii.KINDS) for b in ("", *pii.KINDS)}

        def scores(at, before):
            if at == n:
                yield 0.0, ()
                return
            for j, kind, own in [(at + 1, "", 0.0)] + [
                (j, k, model.weights[k, f[0]]) for i, j, f in segments if i == at for k in pii.KINDS
            ]:
                for s, rest in scores(j, kind):
                    yield s + own + model.weights[before, ">" + kind], ((at, j, kind), *rest)

        best = max(scores(0, ""))
        assert model.best(n, segments) == [x for x in best[1] if x[2]]


def test_redaction_and_base_digest(spark):
    docs = spark.createDataFrame([(1, "to a.b@c.org from 1.2.3.4", 25)], "doc_id long, text string, n_chars long")
    row = pii.report(docs).first()
    base = "email:3:10,ip:18:25"
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in pii.base_spans("to a.b@c.org from 1.2.3.4")[0])
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and row.spans == base
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 0, 0)
    assert tuple(pii.redacted(docs).first()) == (1, "to <email> from <ip>", 20)


def spots(text):
    words = [w for w in re.sub(r"[\W_]+", " ", text.lower()).split(" ") if w]
    content = [(i, w) for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out = set()
    for i, w in enumerate(words):
        rest = [x for k, x in content if k > i][: spotsigs.CHAIN]
        if w in spotsigs.ANCHORS and len(rest) == spotsigs.CHAIN:
            out.add((w, *rest))
    return out or {(" ".join(words) or text,)}


def test_spot_signatures_equal_brute_force(spark):
    r = random.Random(6)
    vocabulary = ["the", "a", "of", "und", "Haus", "cat", "dog's", "Élan", "7", "ran,", "far."]
    texts = [" ".join(r.choices(vocabulary, k=r.randint(0, 40))) for _ in range(60)] + [None, "", "!!!", "the the the"]
    ids = r.sample(range(1000), len(texts) - 1) + [None]
    rows = {x.doc_id: x for x in spotsigs.report(documents(spark, texts, ids).repartition(5)).collect()}
    order = sorted(zip(ids, texts), key=lambda x: -1 if x[0] is None else x[0], reverse=True)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        new = text[: len(text) - n] + after[:n]
        like = lambda a, b: len(spots(a) & spots(b)) / len(spots(a) | spots(b))
        assert rows[i].n_chars == len(text) and rows[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert rows[i].near_edited == pytest.approx(like(text, new)) and rows[i].near_next == pytest.approx(like(text, after))


def test_spot_matches_equal_brute_force(spark):
    r = random.Random(9)
    words = ["the", "of", "and"] * 6 + [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(12):
        base = r.choices(words, k=r.randint(5, 80))
        texts += [" ".join(base), " ".join(base[: len(base) - r.randint(0, 6)]), " ".join(base + r.choices(words, k=2))]
    members, pairs = spotsigs.matches(documents(spark, texts + texts[:3]), percent=80)
    of = {x.doc_id: x.fingerprint for x in members.collect()}
    found = {(x.a, x.b): x.likeness for x in pairs.collect()}
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = spots(texts[i]), spots(texts[j])
        near = len(a & b) / len(a | b)
        if near == 1:
            assert of[i] == of[j]
        else:
            pair = tuple(sorted((of[i], of[j])))
            assert (pair in found) == (5 * len(a & b) >= 4 * len(a | b))
            assert pair not in found or found[pair] == pytest.approx(near)


def test_spotsigs_stay_in_the_jvm(spark, plan, sf_dir):
    text = plan(spotsigs.report(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "SinglePartition" not in text


def test_hilbert_neighbours_are_one_step_apart():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert.hilbert_index(points, bits)
        assert sorted(index) == list(range(len(points)))
        steps = np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_shards_are_even_and_prune(spark):
    rows = [(i, "x" * (i * 37 % 211), f"s{i * 13 % 40:02}", f"l{i % 5}") for i in range(2003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    placed = hilbert.report(docs).collect()
    for s in range(8):
        slots = sorted(r.slot for r in placed if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (250, 251)
    folder = scratch_path(spark, "shards")
    hilbert.write_shards(docs, folder)
    spans = spark.read.parquet(folder).groupBy("_shard").agg(F.min("source").alias("a"), F.max("source").alias("b")).collect()
    read = sum(s.a <= f"s{k:02}" <= s.b for s in spans for k in range(40)) / (40 * 8)
    assert read < 0.7  # of the shards for a filter on one source


def test_token_attribution_equals_brute_force(spark):
    texts = ["one\ntwo three\n\n\nfour", "", None, "a  b\n", "\U0001f600 é\nlast", "\n\n\n\n"]
    docs = spark.createDataFrame([(i, "src", None, t) for i, t in enumerate(texts)], "doc_id long, source string, lang string, text string")
    rows = attribution.attributed(docs, BYTES, ("source", "lang", "text")).collect()
    coder = Tokenizer.from_file(BYTES)
    for i, text in enumerate(texts):
        joined = f"src  {text or ''}"
        mine = sorted((r.start, r.end, r.n_tokens, r.n_crossing) for r in rows if r.doc_id == i)
        assert mine[0][0] == 0 and mine[-1][1] == len(joined) and all(x[1] == y[0] for x, y in zip(mine, mine[1:]))
        tokens, crossing = [0] * len(mine), [0] * len(mine)
        for a, b in coder.encode(joined, add_special_tokens=False).offsets:
            shares = [min(b, y) - max(a, x) for x, y, *_ in mine]
            k = shares.index(max(shares))
            tokens[k] += 1
            crossing[k] += sum(s > 0 for s in shares) > 1
        assert [m[2] for m in mine] == tokens and [m[3] for m in mine] == crossing


def test_fixity_audit_finds_the_damage(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"body {i}") for i in range(700)], "page_id long, url string, html string")
    kept = fixity.leaves(pages)
    assert fixity.audit(kept, fixity.leaves(pages)).where("status != 'ok'").count() == 0
    broken = pages.where("page_id != 17").withColumn("html", F.when(F.col("page_id").isin(3, 699), "?").otherwise(F.col("html")))
    broken = broken.union(spark.createDataFrame([(9999, "http://new", "n")], pages.schema))
    found = fixity.audit(kept, fixity.leaves(broken)).where("status != 'ok'").collect()
    assert {r.key: r.status for r in found} == {17: "missing", 3: "corrupt", 699: "corrupt", 9999: "extra"}
    copies = pages.union(pages.limit(1))
    assert [r.status for r in fixity.audit(kept, fixity.leaves(copies)).where("status != 'ok'").collect()] == ["corrupt"]


def test_wrong_places_do_not_pass_the_audit(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i:03}", "b" * (10 + i % 7)) for i in range(300)], "page_id long, url string, html string")
    kept = fixity.leaves(pages)
    book = fixity.manifest(kept)
    assert fixity.audit(kept, kept, book).where("status != 'ok'").count() == 0
    places = {r.key: (r.id, r.offset, r.length) for r in book.collect()}

    def misplaced(changed):
        rows = [(i, offset) for i, offset, _ in {**places, **changed}.values()]
        found = fixity.audit(kept, kept, spark.createDataFrame(rows, "id string, offset long")).where("status != 'ok'")
        return {r.key: r.status for r in found.collect()}

    # Two records of one length change places, far apart; one offset is wrong; one is not in the copy's manifest.
    a, b = places[21], places[280]
    assert a[2] == b[2]
    assert misplaced({21: (a[0], b[1], a[2]), 280: (b[0], a[1], b[2])}) == {21: "misplaced", 280: "misplaced"}
    assert misplaced({7: (places[7][0], places[7][1] + 1, 0)}) == {7: "misplaced"}
    assert misplaced({7: ("another", 5, 0)}) == {7: "misplaced"}


def test_running_totals_over_many_partitions(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS v").repartitionByRange(6, "id").sortWithinPartitions("id")
    found = with_running_total(rows, F.col("v"), "before", "place").orderBy("id").collect()
    total = 0
    for i, r in enumerate(found):
        assert (r.before, r.place) == (total, i)
        total += r.v


def test_fences_adapt_to_their_group(spark):
    plain = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "en", "a") for i in range(300)]
    marked = [(1000 + i, " ".join(f"w{i}x{k}#" for k in range(30)), "en", "b") for i in range(300)]
    odd = [(5000, " ".join(f"q{k}#" for k in range(30)), "en", "a"), (5001, " ".join(f"q{k}#" for k in range(30)), "en", "b")]
    docs = spark.createDataFrame(plain + marked + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.report(docs).collect()}
    assert not kept[5000] and kept[5001] and sum(kept.values()) == 601


@pytest.mark.parametrize("percent", [30, 50])
def test_a_source_full_of_junk_does_not_lift_its_fence(spark, percent):
    def text(i, mark=""):
        return " ".join(f"w{i}x{k}{mark}" for k in range(30))

    rows = [(i, text(i), "en", f"s{i % 4}") for i in range(1600)]
    rows += [(10000 + i, text(i, "####" if i % 100 < percent else ""), "en", "junk") for i in range(400)]
    rows += [(20000 + i, text(i, "#"), "en", "code") for i in range(300)]  # unlike all others, but not junk
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.report(docs).collect()}
    junk = {i for i, t, _, source in rows if source == "junk" and "#" in t}
    assert len(junk) == 4 * percent and {i for i, k in kept.items() if not k} == junk


def test_repeated_words_equal_brute_force():
    r = random.Random(8)
    for _ in range(200):
        words = r.choices("abc", k=r.randint(0, 60))
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert quality_rules.repeated_words(words) == len(covered)


def test_powers_of_long_texts_and_their_memory(monkeypatch):
    texts = [" ".join(f"w{i}" for i in range(k)) for k in (3, 40, 900)]
    whole, at = shingle_sets(pa.array(texts), 3)
    monkeypatch.setattr(shingles_module, "BLOCK", 16)
    common._HELD.clear()
    try:
        again, places = shingle_sets(pa.array(texts), 3)
        assert (again == whole).all() and (places == at).all()
        assert sum(x.nbytes for x in shingles_module._block()) == 2 * 8 * 16
    finally:
        common._HELD.clear()


def test_shingles_of_a_batch_take_little_memory():
    class Docs:
        def mapInArrow(self, run, schema):
            return run

    texts = [" ".join(f"w{k}x{i}" for i in range(200)) for k in range(2500)]  # 3 MB
    batch = pa.record_batch({"id": pa.array(range(len(texts))), "text": pa.array(texts)})

    def rows(part):
        values, at = shingle_sets(part.column("text"), 5)
        order, sizes = jaccard_join._prefixes(values, at, 80, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        return {"n": pa.array(sizes + 0 * len(order))}

    common._HELD.clear()
    tracemalloc.start()
    try:
        found = [n for part in jaccard_join._over_texts(Docs(), "n long", rows)([batch]) for n in part.column("n").to_pylist()]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        common._HELD.clear()
    assert found == [jaccard_join.prefix_size(196, 80)] * len(texts)
    assert most < 24 << 20


def test_another_owner_gives_memory_back_to_the_system(monkeypatch):
    asked = []

    class Pool:
        def release_unused(self):
            asked.append(dict(common._HELD))

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    common._HELD.clear()
    try:
        common.worker_cache("one", lambda: [1])
        common.worker_cache("two", lambda: [2])
        assert common.worker_cache("two", lambda: [3]) == [2]
    finally:
        common._HELD.clear()
    assert asked == [{}, {}]  # once an owner, after what the other kept is gone


def test_an_encoder_remembers_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_BYTES", 20_000)
    coder = tokens.Encoder(tokens.vocabulary(BYTES))
    theirs = Tokenizer.from_file(BYTES)
    for k in range(6):
        texts = [" ".join(f"word{i % 900}" for i in range(s, s + 60)) for s in range(0, 900, 50)]
        coded = coder.encode(texts)
        assert [coder.ids(c).tolist() for c in coded] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    held = sum(map(sys.getsizeof, coder.known)) + sum(map(sys.getsizeof, coder.known.values()))
    assert 8_000 < held < 21_000 and len(coder.known) < 900
    tokens.encoder(tokens.vocabulary(BYTES))
    tokens.encoder(tokens.vocabulary(WORD_PARTS))
    assert len(common._HELD) == 1
    shingle_sets(pa.array(["one operator's cache at a time"]), 3)
    assert list(common._HELD) == ["powers"]


def test_the_pipelines_packing_takes_little_memory_of_a_worker(spark, monkeypatch):
    class Docs:
        sparkSession = spark
        schema = spark.createDataFrame([], "doc_id long, text string").schema

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Asked(Exception):
        pass

    def asked(*args):
        raise Asked(args)

    cut = packing.pieces
    monkeypatch.setattr(packing, "pieces", asked)
    with pytest.raises(Asked) as caught:
        corpus_pipeline.packed(spark, Docs(), "")
    texts = [" ".join(f"w{i}x{k}" for i in range(250)) for k in range(1600)]  # 400,000 pieces
    batches = [pa.record_batch({"key": pa.array([s]), "text": pa.array([" ".join(texts[s : s + 40])])}) for s in range(0, 1600, 40)]
    common._HELD.clear()
    try:
        found = [r for b in cut(*caught.value.args[0])(iter(batches)) for r in b.to_pylist()]
        (coder,) = common._HELD.values()
        held = sum(map(sys.getsizeof, coder.known)) + sum(map(sys.getsizeof, coder.known.values()))
    finally:
        common._HELD.clear()
    assert 0 < held + sys.getsizeof(coder.known) < 36 << 20
    theirs = Tokenizer.from_file(WORD_PARTS)
    for row in (found[0], found[-1]):
        text = next(b["text"][0].as_py() for b in batches if b["key"][0].as_py() == row["key"])
        ids = [*theirs.encode(text, add_special_tokens=False).ids, packing.END][row["start"] :][: packing.CAPACITY]
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_factored_patterns_match_the_same_words():
    r = random.Random(21)
    for _ in range(200):
        words = ["".join(r.choices("abü", k=r.randint(1, 4))) for _ in range(r.randint(1, 12))]
        pattern = re.compile(spotsigs.factored(words))
        for word in {*words, *("".join(w) for k in range(4) for w in itertools.product("abü", repeat=k))}:
            assert bool(pattern.fullmatch(word)) == (word in words)


def test_texts_are_measured_once_a_pass(spark, plan, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows in (quality_rules.keep_good(docs), quality_rules.sketches(quality_rules.with_measures(docs))):
        assert plan(rows).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("path", [BYTES, WORD_PARTS])
def test_new_pieces_are_encoded_together(path):
    theirs = Tokenizer.from_file(path)
    coder = tokens.Encoder(tokens.vocabulary(path))
    sizes, encode = [], coder.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **more):
            sizes.append(len(texts))
            return encode(texts, **more)

    coder.tokenizer = Counted()
    r = random.Random(41)
    signs = ["a", "Bc", "1", ".", "\n", "\u0301", "é", "ſ", "\0", "日", "<", "|", ">", "<|endoftext|>", "<|startoftext|>", "<|endof", "text|>", "'", "s"]
    texts = ["", *[" ".join("".join(r.choices(signs, k=r.randint(1, 5))) for _ in range(r.randint(0, 9))) for _ in range(2000)]]
    found = [coder.ids(c).tolist() for c in coder.encode(texts)]
    assert found == [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    sizes.clear()
    coder.encode([" ".join(f"new{i}" for i in range(5000))])
    assert sum(sizes) <= 5000 // tokens.JOINED + 1


def test_pieces_are_cut_at_blanks_between_other_characters():
    r = random.Random(31)
    cut = re.compile(r"(?<=\S)(?= \S)")
    for _ in range(5000):
        text = "".join(r.choices(["a", "bc", " ", " ", "\n", "\t", " ", "　", "é", ".", "\0", "\x85"], k=r.randint(0, 14)))
        found = tokens.pieces_of(text)
        assert "".join(found) == text
        expected = cut.split(text)
        # A blank at either end of a text may stand alone.
        assert [p for p in found if p.strip(" ")] == [p for p in expected if p.strip(" ")] or text != text.strip(" ")
