"""Byte-level BPE, the Merkle manifest and the source audit against brute force and odd tables."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scorewatch.llm import byte_bpe, merkle_manifest, source_divergence

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, place long, item string"


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars), with further columns of clashing names."""
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], DOCS).repartition(3)


# Byte-level BPE

@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = byte_bpe.read_ranks(tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ranks, tokenizers.PATTERN, whole


ODD_TEXTS = [
    None, "", " ", "\n", "one", "Hello world", "  two  spaces ", "tabs\t\tand\n\n lines \n  x 　y",
    "it's they'll we've I'M", "naïve façade — Überraschung", "日本語のテキスト、漢字", "emoji 👩‍👩‍👧 🇫🇷 é é",
    "a1b22c333 4,567.89", "\x1c\x1d\x85 end", "<|endoftext|> is text", "x" * 700, "ab" * 300 + "!" * 300,
    "trailing   ", "​﻿\U0010ffff", "aaaaaaaa " * 40, " " * 200 + "z", "\r\n\r\nq",
]


def random_texts():
    rng = random.Random(5)
    alphabet = "abcdeéßñ日🙂 \n\t.,'0123ABC "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120))) for _ in range(150)]


@pytest.mark.parametrize("size", [300, 16_000_000])
def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, tokenizer, monkeypatch, size):
    ranks, pattern, whole = tokenizer
    monkeypatch.setattr(byte_bpe, "BATCH_CHARS", size)
    texts = ODD_TEXTS + random_texts()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(5, texts[5], "en", "s", 1), (None, "no id", "", "", 0)]
    encoded = byte_bpe.encode(frame(spark, rows), ranks, pattern, bucket_chars=size)
    got = byte_bpe.decode(encoded, ranks, out="bytes").collect()
    assert sorted(encoded.columns) == ["doc_id", "ids"]
    found = Counter((r["doc_id"], tuple(r["ids"]), bytes(r["bytes"])) for r in got)
    assert found == Counter((i, tuple(whole.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in rows)


def test_ids_of_an_empty_table_and_unknown_ids(spark, tokenizer):
    ranks, pattern, _ = tokenizer
    assert byte_bpe.encode(frame(spark, []), ranks, pattern).collect() == []
    rows = spark.createDataFrame([([0, 50256],), ([],), ([33],), (None,), ([None],)], "ids array<int>").coalesce(1)
    assert [r["decoded"] for r in byte_bpe.decode(rows, ranks).collect()] == [None, b"", b"B", None, None]


def test_the_fold_takes_the_leftmost_of_equal_pairs(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 299, b"abc": 400, b"aa": 301}
    word = spark.createDataFrame([(w.hex(),) for w in (b"abc", b"aaa", b"ab", b"aaaab", b"q")], "w string")
    found = word.select(byte_bpe.merged_ids(F.col("w"), byte_bpe.rank_maps(ranks))).collect()
    assert [r[0] for r in found] == [[400], [301, 97], [300], [301, 97, 300], [113]]
    # "abc" is a piece itself; inside a longer word its pair of lowest rank is merged first
    longer = spark.createDataFrame([(b"abcx".hex(),)], "w string")
    assert longer.select(byte_bpe.merged_ids(F.col("w"), byte_bpe.rank_maps(ranks))).first()[0] == [400, 120]


def brute_merges(word, ranks):
    """Ids of a word that is no piece, a merge at a time."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 2**31 - 1), i) for i in range(len(parts) - 1))
        if rank == 2**31 - 1:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks.get(part, 2**31 - 1) for part in parts]


def test_ids_laid_out_and_decoded_in_small_parts(spark, tokenizer, monkeypatch):
    ranks, pattern, whole = tokenizer
    monkeypatch.setattr(byte_bpe, "PART_IDS", 3)
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)]
    edges = byte_bpe.np.array([0, 0, 2, 2, 9, 10, 11, 12, 13, 13])
    assert list(byte_bpe.in_parts(edges)) == [(0, 3), (3, 4), (4, 7), (7, 9)]
    got = byte_bpe.decode(byte_bpe.encode(frame(spark, rows), ranks, pattern), ranks, out="bytes").collect()
    assert {r["doc_id"]: (r["ids"], bytes(r["bytes"])) for r in got} == {
        i: (whole.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows}


def test_matrix_and_heap_merge_as_one_pair_at_a_time(monkeypatch):
    rng = random.Random(8)
    pieces = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randint(2, 6))) for _ in range(400)})
    order = rng.sample(range(1000), len(pieces))  # of any order, so a merge may make a pair of lower rank
    ranks = {bytes([b]): 2000 + b for b in range(256) if b != ord("d")} | dict(zip(pieces, order))
    words = list({bytes(rng.choice(b"abcde") for _ in range(rng.randint(1, 40))) for _ in range(600)} - set(ranks))
    expected = [brute_merges(word, ranks) for word in words]
    assert [ids.tolist() for ids in byte_bpe.Merges(ranks)(words)] == expected
    monkeypatch.setattr(byte_bpe, "LONG", 1)
    assert [ids.tolist() for ids in byte_bpe.Merges(ranks)(words)] == [brute_merges(word, ranks) for word in words]


def test_unbroken_words_of_any_length(tokenizer):
    ranks, _, whole = tokenizer
    word = "".join(random.Random(3).choice("abcdefghijklmnop") for _ in range(40_000))
    assert byte_bpe.Merges(ranks)([word.encode()])[0].tolist() == whole.encode_ordinary(word)


def test_words_of_many_texts_are_those_of_the_pattern(tokenizer):
    import regex
    _, pattern, _ = tokenizer
    texts = ODD_TEXTS + random_texts() + [" a  b\n\nc d ", "x\u3000\u3000y z", " ", "a\u00a0 b", "  ", "\n a"]
    cut = byte_bpe.Cut(pattern)
    for part in (texts, texts[:1], texts[40:90]):
        numbers, sizes = cut.words(part)
        words, ends = list(cut.numbers), sizes.cumsum()
        got = [[words[n] for n in numbers[end - size:end]] for size, end in zip(sizes, ends)]
        assert got == [regex.findall(pattern, text or "") for text in part]


def test_decoding_of_batches_without_any_id(spark, tokenizer):
    rows = spark.createDataFrame([([],), ([],), (None,)], "ids array<int>").coalesce(1)
    assert [r["decoded"] for r in byte_bpe.decode(rows, tokenizer[0]).collect()] == [b"", b"", None]


def test_numbers_by_planes():
    import numpy as np
    for values in ([], [0], [1, 2**32 - 1, 70000]):
        assert byte_bpe.unsqueezed(byte_bpe.squeezed(np.array(values, np.uint32))).tolist() == values


# Merkle manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def brute_tree(leaves):
    """Levels of nodes, from the leaves up to the root."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def brute_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        if (i ^ 1) < len(nodes):
            out.append(nodes[i ^ 1])
        i //= 2
    return out


def brute_leaf(row):
    doc_id, text, lang, source, n_chars = row
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(written, (doc_id, source, lang, n_chars, text)))


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_manifest_is_that_of_brute_force(spark, levels):
    rng = random.Random(3)
    rows = [(i * 3, rng.choice([None, "", "a text", "é" * 50, "1:x"]), lang, rng.choice([None, "s", "-"]),
             rng.choice([None, 4, 2**63 - 1]))
            for lang, n in (("en", 21), (None, 6), ("de", 1), ("é", 16), ("", 2)) for i in range(n)]
    rows = [(r[0] + 1000 * k, *r[1:]) for k, r in enumerate(rows)]
    got = merkle_manifest.manifest(frame(spark, rows), "lang", "doc_id", FIELDS, levels=levels).collect()
    parts = defaultdict(list)
    for row in sorted(rows):
        parts[row[2]].append(row)
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: brute_tree([brute_leaf(r) for r in parts[name]]) for name in names}
    top = brute_tree([trees[name][-1][0] for name in names])
    want = {}
    for name in names:
        for i, row in enumerate(parts[name]):
            path = brute_path(trees[name], i) + brute_path(top, names.index(name))
            want[row[0]] = (brute_leaf(row), trees[name][-1][0], top[-1][0], "".join(path), top[-1][0])
    assert {r["doc_id"]: (r["leaf"], r["subroot"], r["root"], r["proof"].hex(), r["folded"]) for r in got} == want
    assert len(got) == len(rows)


def test_a_claimed_field_is_found_out(spark):
    rows = [(i, "t", "en", "s", None if i == 3 else i) for i in range(9)]
    claimed = {"n_chars": F.when(F.col("doc_id") % 2 == 1, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = merkle_manifest.manifest(frame(spark, rows), "lang", "doc_id", FIELDS, claimed=claimed).collect()
    assert {r["doc_id"] for r in got if r["folded"] != r["root"]} == {1, 5, 7}


def test_manifest_of_repeated_null_and_missing_rows(spark):
    rows = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (None, "a", "en", "s", 1)]
    got = merkle_manifest.manifest(frame(spark, rows), "lang", "doc_id", FIELDS, levels=1).collect()
    first, *others = [brute_leaf(rows[3]), *sorted(brute_leaf(r) for r in rows[:3])]
    assert {r["root"] for r in got} == {h(h(first, others[0]), h(*others[1:]))}
    assert len(got) == 4 and all(r["folded"] == r["root"] for r in got)
    single = merkle_manifest.manifest(frame(spark, rows[:1]), "lang", "doc_id", FIELDS).first()
    assert single["root"] == single["subroot"] == single["leaf"] and single["proof"] == b""
    assert merkle_manifest.manifest(frame(spark, []), "lang", "doc_id", FIELDS).collect() == []


def test_appends_extend_witnesses_like_the_whole_tree():
    leaves = [h(str(i)) for i in range(13)]
    tree = merkle_manifest.Appended()
    for leaf in leaves:
        tree.append(leaf)
    levels = brute_tree(leaves)
    assert tree.close(merkle_manifest.depth(13)) == levels[-1][0]
    assert tree.witnesses == [brute_path(levels, i) for i in range(13)]
    assert [merkle_manifest.depth(n) for n in (0, 1, 2, 3, 4, 5)] == [0, 0, 1, 2, 2, 3]
    for i, leaf in enumerate(leaves):
        assert merkle_manifest.folded(leaf, i, 13, tree.witnesses[i]) == levels[-1][0]


# Source divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, least, top):
    texts = defaultdict(list)
    for _, text, lang, source, _ in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        texts[lang or "", source or ""].append(Counter(TERM.findall(low)))
    out = set()
    for lang in {g[0] for g in texts}:
        held = Counter(t for g, docs in texts.items() if g[0] == lang for d in docs for t in d)
        kept = [t for t, n in held.items() if n >= least]
        groups = {g[1]: sum(docs, Counter()) for g, docs in texts.items() if g[0] == lang}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {g: shares(c) for g, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))

        def f(a, b):
            return (a - b)**2 // (a + b)
        for g in groups:
            pairs = [(o, sum(f(p[g][t], p[o][t]) for t in kept)) for o in groups if o != g]
            terms = [(t, f(p[g][t], q[t])) for t in kept if groups[g][t] and p[g][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, g, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])}
    return out


def audited(df, **options):
    found = source_divergence.audit(df, **options)
    return [tuple(r) for r in found.select("section", "grp", "part", "item", "value", "rank").collect()]


@pytest.mark.parametrize("entries", [20, 250_000])
def test_audit_is_that_of_brute_force(spark, monkeypatch, entries):
    monkeypatch.setattr(source_divergence, "BLOCK_ENTRIES", entries)
    rng = random.Random(11)
    words = ["Alpha", "beta", "gämma", "δ", "eps", "zeta's", "x1y", "日本", "rare", "Ω"]
    rows = [(i, " ".join(rng.choice(words[:rng.randint(2, 10)]) for _ in range(rng.randint(0, 30))),
             rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None, "B"]), 1) for i in range(120)]
    rows += [(900, None, "en", "silent", 0), (901, "12 34 !", "xx", "p", 0), (902, None, "xx", "q", 0),
             (903, "alpha " * 5000, "en", "loud", 0), rows[0], rows[0]]
    got = audited(frame(spark, rows), least_docs=10)
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, 10, 10)


def test_audit_of_an_empty_table_and_of_no_kept_terms(spark):
    assert audited(frame(spark, [])) == []
    assert sorted(audited(frame(spark, [(1, "a b", "en", "s", 1), (2, "b c", "en", "t", 1)]))) == [
        ("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_runs_bound_the_arrays_in_flight():
    import numpy as np
    own, sizes = np.arange(6), np.array([3, 3, 3, 9, 1, 1])
    parts = list(source_divergence._runs(own, sizes, 6))
    assert np.concatenate(parts).tolist() == own.tolist() and len(parts) > 2
    assert list(source_divergence._runs(own[:0], sizes[:0])) == []
