"""Each operator against a brute-force version, and on nulls, empty tables, ties and repeats."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorewatch.llm import (exact_top_k, language_id, lm_scores, mixing, near_duplicates, packing,
                            personal_data, quality_classifier, quality_rules, url_filters)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, label int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_text(seed, n=120):
    rng = np.random.RandomState(seed)
    parts = ["an", "ber", "cho", "du", "el", "fi", "gra", "hu", "ist", "ker"]
    return " ".join("".join(rng.choice(parts, rng.randint(1, 4))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    texts = [base_text(i) for i in range(8)]
    edited = texts[0].split(" ")
    edited[5], edited[60] = "changed", "words"
    texts += [texts[0], " ".join(edited), texts[1].upper(), None, "", " \n ", "one", "a b c " * 60,
              "mail x.y@example.com or +1 (620) 555-8424, card 4111 1111 1111 1111 ip 10.0.0.1 " + texts[3],
              "é" + texts[2], texts[4] * 40, "#$%& " * 30]
    found = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s3"][i % 4], len(t or ""), i, "x", 1)
             for i, t in enumerate(texts)]
    return found + [found[2], found[2], (None, texts[5], "en", "s1", 3, 1, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, k):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and 5 * both >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return sets, root


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_are_those_of_brute_force(docs, rows, k):
    sets, root = brute_groups({r[0]: r[1] for r in rows if r[0] is not None}, k)
    found = near_duplicates.near_duplicates(docs, shingle=k).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
            assert r.kept == (r.component_id == r.doc_id)


def test_one_of_each_group_stays(docs, rows, none):
    kept = near_duplicates.keep_one(docs, shingle=2).collect()
    _, root = brute_groups({r[0]: r[1] for r in rows if r[0] is not None}, 2)
    assert Counter(r.doc_id for r in kept) == Counter({i: 1 for i in root if root[i] == i} | {None: 1})
    assert near_duplicates.keep_one(none).count() == 0


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    a, b = base_text(1), base_text(2)
    rows = [(1, a), (1, b), (2, a), (3, b + " word"), (1, a), (1, None)]
    kept = near_duplicates.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text or "")[:20] for r in kept) == sorted(["", a[:20], b[:20]])
    assert {(r.doc_id, r.text) for r in kept} <= set(rows) and len(kept) == 3


def test_a_large_group_of_near_copies_is_one_component(spark):
    words = base_text(3, 300).split(" ")
    rng = np.random.RandomState(1)
    texts = []
    for i in range(200):
        own = list(words)
        for at in rng.choice(300, 8, replace=False):
            own[at] = f"own{i}x{at}"
        texts.append((i, " ".join(own)))
    found = near_duplicates.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=2)
    _, root = brute_groups(dict(texts), 2)
    assert {r.doc_id: r.component_id for r in found.collect()} == root


def test_alike_documents_that_are_no_links_give_no_row_for_each_pair(spark, monkeypatch):
    words, rng, texts = base_text(3, 300).split(" "), np.random.RandomState(1), {}
    for i in range(300):
        own = list(words)
        for at in rng.choice(300, rng.randint(9, 13), replace=False):
            own[at] = f"own{i}x{at}"
        texts[i] = " ".join(own)
    _, root = brute_groups(texts, 2)
    assert 10 < len(set(root.values())) < 290
    docs, written, write = spark.createDataFrame(list(texts.items()), "doc_id long, text string"), [], near_duplicates.work_table

    def counted(df, name):
        found = write(df, name)
        written.append((name, found.count()))
        return found
    monkeypatch.setattr(near_duplicates, "work_table", counted)
    for name, size in [(None, None), ("BLOCK_MEMBERS", 70), ("BLOCK_SHINGLES", 20_000), ("BIN_MEMBERS", 500)]:
        if name:
            monkeypatch.setattr(near_duplicates, name, size)
        found = near_duplicates.near_duplicates(docs, shingle=2)
        assert {r.doc_id: r.component_id for r in found.collect()} == root
        assert name or max(n for _, n in written) <= near_duplicates.BANDS * len(texts), written


def test_cells_join_what_all_their_pairs_join():
    rng = np.random.RandomState(4)
    base = np.unique(rng.randint(0, 2**62, 90).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[:rng.randint(76, 90)],
                                      rng.randint(0, 2**62, rng.randint(1, 9)).astype(np.uint64)])) for _ in range(60)]
    before = rng.randint(0, 40, 60)

    def joined(pairs):
        labels = before.copy()
        for a, b in pairs:
            labels[labels == labels[b]] = labels[a]
        return [labels.tolist().index(x) for x in labels]
    common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for b in range(60) for a in range(b)}
    links = [(a, b) for (a, b), n in common.items() if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n)]
    found = near_duplicates.cell_links(before, sets, 4, 5)
    assert set(found) <= set(links) and len(found) < 40 and joined(found) == joined(links)
    values = near_duplicates.signatures(sets, 150)
    limits = near_duplicates.least_matches(0.8, 1e-7, 150, 15)
    forest = near_duplicates.cell_forest(before, np.array([len(s) for s in sets]), values, 4, 5, limits)
    assert len(forest) < 60 and joined(forest) == joined([*forest, *links])


def test_posterior_keeps_pairs_at_the_threshold():
    limits = near_duplicates.least_matches(0.8, 1e-7, 150, 15)
    rng = np.random.RandomState(0)
    left = rng.randint(0, 60000, (2000, 150)).astype(np.uint16)
    right = np.where(rng.rand(2000, 150) < 0.8, left, left + 1).astype(np.uint16)
    assert len(near_duplicates.posterior_survivors(left, right, limits)[0]) == 2000
    far = np.where(rng.rand(2000, 150) < 0.3, left, left + 1).astype(np.uint16)
    assert len(near_duplicates.posterior_survivors(left, far, limits)[0]) == 0


def test_packing_round_trip(docs, rows, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path, length=256, open_windows=3).collect()
    want = Counter((r[0], np.array(whole.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
                   for r in rows)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for key, own in by_doc.items():
        texts = [ids for (k, ids), n in want.items() if k == key for _ in range(n)]
        assert sorted(len(t) // 4 for t in texts) == sorted(
            p.doc_tokens for p in own if p.start == 0)
        if len(texts) == 1:
            own.sort(key=lambda p: p.start)
            assert b"".join(bytes(p.ids) for p in own) == texts[0]
    used = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        used[p.sequence_id].append((p.offset, p.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(none, path).count() == 0


@pytest.mark.parametrize("limit", [400_000, 2])
def test_chunks_give_the_tokenizers_own_ids(limit, monkeypatch):
    import pyarrow as pa
    import public_tokenizers
    monkeypatch.setattr(packing.Tokens, "LIMIT", limit)
    tokens = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["It's o'Neil's don't <|endoftext|>x", None, "ΣΑΣ é é a b ½² \x85 q\x1cq 漢字 😀\tt", "",
             "'''s ..'s I'LL ª", "Word word, WORD word! a--b  a--b\n\nword$$$ wörd WÖRD"]
    for cut in (texts, texts[2:], [None], [""], []):
        array = pa.array(texts + cut, pa.string()).slice(len(texts))  # begins within its buffers
        data, at = tokens.of_texts(array)
        assert len(at) == len(cut) + 1
        for text, since, until in zip(cut, at, at[1:]):
            whole = tokens.whole.encode(text or "", add_special_tokens=False).ids
            assert bytes(data[since:until]) == np.array(whole, "<u4").tobytes()


def test_a_worker_keeps_few_chunks_after_its_task(monkeypatch):
    import pyarrow as pa
    import public_tokenizers
    monkeypatch.setattr(packing.Tokens, "LIMIT", 300)
    monkeypatch.setattr(packing.Tokens, "KEPT", 20)
    held = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    texts = pa.array([base_text(i) + " 12,5 a-b" for i in range(12)])
    first, at = held.of_texts(texts)
    first = bytes(first)
    assert len(held) + len(held.before) > 300
    held.rest()
    assert max(len(held), len(held.known)) <= 20 and not held.before
    again, upto = held.of_texts(texts)
    assert bytes(again) == first and upto == at


def test_mix_meets_its_targets(docs, rows, none):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    found = mixing.mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in found:
        assert r._mix_size == len(WORD.findall(r.text or "")) and r._mix_source_size == sizes[r.source]
        assert 0 <= r._mix_taken <= 3 * r._mix_size
        taken[r.source] += r._mix_taken
        target[r.source] = r._mix_target
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 3 * sizes[s] + 1e-6 for s in target)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r._mix_taken) for r in found) == Counter((r.doc_id, r._mix_taken) for r in again)
    stream = mixing.training_stream(docs).collect()
    assert sum(len(WORD.findall(r.text)) for r in stream) == sum(taken.values())
    assert [r.position for r in stream] == sorted(r.position for r in stream)
    assert mixing.mix(none).count() == mixing.training_stream(none).count() == 0


def test_quality_statistics(docs, rows, none):
    found = quality_rules.quality_rules(docs).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {i + j for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(none).count() == quality_rules.drop_low_quality(none).count() == 0
    kept = quality_rules.drop_low_quality(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if r.kept)


def varied_text(seed):
    """Two kinds of syllables in shares that vary from text to text."""
    rng = np.random.RandomState(seed)
    parts = [["an", "ber", "cho", "du", "el", "fi", "gra", "hu", "ist", "ker"], ["wex", "oz", "vip", "jo", "qua"]]
    share = rng.normal(0.5, 0.08)
    return " ".join("".join(rng.choice(parts[int(rng.rand() < share)]) for _ in range(rng.randint(1, 4)))
                    for _ in range(150))


def test_bands_reject_junk_and_menus_and_keep_clean_texts(spark):
    clean = [varied_text(i) for i in range(150)]
    junk = [" ".join(w + "%%%" if i % 4 == 1 else w for i, w in enumerate(varied_text(seed).split(" ")))
            for seed in (200, 201, 202)]
    menus = [varied_text(seed).replace(" ", " | ", 85) for seed in (300, 301, 302)]
    frame = spark.createDataFrame(list(enumerate(clean + junk + menus)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality_rules.quality_rules(frame.withColumn("lang", F.lit("en"))).collect()}
    assert not any(r.base_failed for r in found.values())
    assert not any(found[i].kept for i in range(150, 156))
    assert sum(found[i].kept for i in range(150)) >= 148


def brute_perplexity(texts, text, order):
    """Modified Kneser-Ney of code points of the asked order; the mean over ``text``."""
    levels = {order: Counter(p[i + 5 - order:i + 5] for t in texts for p in ["\0" * 4 + t] for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def probability(gram):
        k = len(gram)
        if not k:
            return 1 / 0x110000
        lower, level = probability(gram[1:]), levels[k]
        n = [sum(c == i for c in level.values()) for i in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        if min(n[1:4]):
            y = n[1] / (n[1] + 2 * n[2])
            d = [0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3))]
        follow = [c for g, c in level.items() if g[:-1] == gram[:-1]]
        if not follow:
            return lower
        own = level[gram]
        return (own - d[min(own, 3)] + sum(d[min(c, 3)] for c in follow) * lower) / sum(follow)

    padded = "\0" * 4 + text
    return -np.mean([np.log(probability(padded[i + 5 - order:i + 5])) for i in range(len(text))])


def test_five_grams_of_code_points_are_those_of_brute_force(spark):
    texts = [varied_text(i)[:160] for i in range(6)] + ["слово за слово " * 4, "слова злова " * 5, "字典文字 中文"]
    rows = [(i, t, "en") for i, t in enumerate(texts + texts[:1] + [""])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = {r.doc_id: r._quality for r in quality_rules.scored(frame).collect()}
    for i, t in enumerate(texts):
        model = [x for x in texts + texts[:1] if quality_rules.half_of(x) != quality_rules.half_of(t)]
        assert found[i].log_perplexity == pytest.approx(brute_perplexity(model, t, 5))
        assert found[i].short_perplexity == pytest.approx(brute_perplexity(model, t, 3))
    assert found[9] == found[0] and found[10].log_perplexity is None


def test_model_is_sorted_hash_arrays_whose_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "BUCKET_CHARS", 700)
    texts = [varied_text(i)[:300] for i in range(8)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    rows = quality_rules.dealt(frame, "text", "lang").selectExpr(
        "_quality_lang lang", "_quality_half half", "_quality_buckets buckets", "text").repartition(3)
    found = quality_rules.model(rows).collect()
    assert len({r.bucket for r in found}) == len(found) > 1
    known = {}
    for r in found:
        hashes = np.frombuffer(r.hashes, np.uint64)
        assert (np.diff(hashes.astype(object)) > 0).all()
        known |= dict(zip(hashes.tolist(), np.exp(-np.frombuffer(r.p0, np.float32))))
    grams = quality_rules.Grams(texts, 1)
    keys = quality_rules.gram_keys(grams.hi, grams.lo)
    assert set(known) == set(keys.tolist())
    model = [t for t in texts if quality_rules.half_of(t) == 0]
    for t in texts[:2]:
        own = quality_rules.Grams([t], 1)
        mean = -np.repeat([np.log(known[k]) for k in quality_rules.gram_keys(own.hi, own.lo).tolist()], own.counts).mean()
        assert mean == pytest.approx(brute_perplexity(model, t, 5), rel=1e-5)


@pytest.mark.parametrize("letters", [30, 9000])  # more than 7131 do not fit as digits of 64 bits
def test_distinct_five_grams_of_small_and_large_alphabets(letters, monkeypatch):
    monkeypatch.setattr(quality_rules, "RUN", 5000)
    rng = np.random.RandomState(letters)
    texts = ["".join(map(chr, 0x4E00 + rng.randint(0, letters, n))) for n in (12_000, 1, 700)] + ["", "\U0010ffff" * 9]
    texts.append("".join(map(chr, range(0x4E00, 0x4E00 + letters))))
    grams = quality_rules.Grams(texts, 7)
    expected = Counter(tuple(map(ord, p[i:i + 5])) for t in texts for p in ["\0" * 4 + t] for i in range(len(t)))
    ones = quality_rules.ONE
    found = [(int(h) >> 21, int(h) & ones, int(l) >> 42, (int(l) >> 21) & ones, int(l) & ones)
             for h, l in zip(grams.hi, grams.lo)]
    assert dict(zip(found, grams.counts)) == expected and len(found) == len(expected)
    read = quality_rules.read_grams(quality_rules.stored_grams(grams.hi, grams.lo))
    assert (read[0] == grams.hi).all() and (read[1] == grams.lo).all()
    ends = [found[c] for codes in grams.codes for c in codes]
    assert ends == [tuple(map(ord, p[i:i + 5])) for t in texts for p in ["\0" * 4 + t] for i in range(len(t))]


def test_batches_runs_and_buckets_change_no_figure(spark, monkeypatch):
    texts = [varied_text(i)[:200 + 40 * i] for i in range(12)] + ["", None, "a", "é" * 500]
    rows = [(i, t, "de" if i % 3 else None, i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, bucket long").repartition(2)
    whole = {r.doc_id: r._quality for r in quality_rules.scored(frame).collect()}
    for name, value in (("BATCH_CHARS", 500), ("BUCKET_CHARS", 300), ("HELD_CHARS", 700), ("RUN", 64)):
        monkeypatch.setattr(quality_rules, name, value)
    parts = quality_rules.scored(frame)
    assert parts.columns == [*frame.columns, "_quality"]
    for r in parts.collect():
        for name in quality_rules.PERPLEXITIES:
            expected = whole[r.doc_id][name]
            assert (r._quality[name] is None) == (expected is None)
            assert expected is None or r._quality[name] == pytest.approx(expected, rel=1e-6)
    assert len(whole) == len(texts) and whole[12].log_perplexity is whole[13].log_perplexity is None


def test_a_language_with_one_kind_of_checksum_has_no_figure_and_passes(spark):
    texts = [t for t in map(varied_text, range(40)) if quality_rules.half_of(t)][:8]
    frame = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality_rules.quality_rules(frame).collect():
        assert r.log_perplexity is None and r.kept


def brute_spans(text):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0
    plain = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[ -]", "", m)) <= 19
              and luhn(re.sub("[ -]", "", m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= sum(c.isdigit() for c in m) <= 15)]
    return sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(plain)
                  for m in re.finditer(p, text or "") if ok(m.group()))


def test_personal_data(spark, docs, none):
    odd = ["a@b.c_x@y.z a@b.c.@x.y é1.2.3.4.5 300.1.1.1 0000001.2.3.4", "9" * 20000 + "a" * 20000, None, "",
           "GB82 WEST 1234 5698 7654 32 ssn 123-45-6789 456-78-1234 call 555-123-4567", "1.1.1.1.1.1.1.1.1",
           "x@y.z 4111-1111-1111-1111 +1 (620) 555-8424", 'token = "0a1b2c3d4e5f60718293a4b5c6d7e8f9"']
    both = docs.select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string"))
    kinds = set()
    for r in personal_data.with_spans(both).collect():
        base = [(s.start, s.rank, s.end, s.kind) for s in r.spans if s.rank < 4]
        assert base == brute_spans(r.text)
        kinds |= {s.kind for s in r.spans}
        for s in r.spans:
            assert r.text[s.start:s.end] == s.value
    assert {"iban", "ssn", "local_phone", "secret"} <= kinds
    clean = [r.text for r in personal_data.redact(both).collect()]
    assert clean.count(None) == 2 and not any("@y.z" in (t or "") for t in clean)
    assert "<CARD>" in " ".join(t for t in clean if t)
    assert personal_data.with_spans(none).count() == 0


def test_personal_data_counts_by_kind(spark, tmp_path):
    texts = ["a@b.c d@e.f 1.2.3.4", "+1 (620) 555-8424", "4111 1111 1111 1111 x@y.z", "nothing", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    for r in personal_data.op9_pii(spark, str(tmp_path)).collect():
        base = brute_spans(texts[r.doc_id])
        kinds = [name for *_, name in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base).encode()).hexdigest()


def test_language_profiles(docs, none, spark):
    held = language_id.held_out()
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").otherwise(F.col("lang")))
    found = language_id.identify(docs, docs.filter(~held).select("text", "lang")).collect()
    for r in found:
        assert 0 <= r.score <= 1
        if not re.search("[a-zé]", (r.text or "").lower()):
            assert (r.lang_pred, r.score) == ("und", 0)
    assert language_id.identify(none, none.select("text", "lang")).count() == 0
    alone = language_id.identify(docs, none.select("text", "lang"))
    assert {r.lang_pred for r in alone.collect()} == {"und"}
    one = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string")
    guess = language_id.identify(one.select("text"), one).collect()
    assert {(r.text[:3], r.lang_pred) for r in guess} == {("the", "en"), ("der", "de")}


def test_backoff_scores(docs, rows, none):
    texts = [(r[0], WORD.findall((r[1] or "").lower())) for r in rows]
    ones = Counter(w for _, ws in texts for w in ws)
    pairs = Counter(p for _, ws in texts for p in zip(ws, ws[1:]))
    n = sum(ones.values())
    want = Counter()
    for key, ws in texts:
        logs = [np.log(ones[w] / n) if i == 0 else np.log(pairs[ws[i - 1], w] / ones[ws[i - 1]])
                if pairs[ws[i - 1], w] >= 2 else np.log(0.4 * ones[w] / n) for i, w in enumerate(ws)]
        want[key, len(ws), round(float(np.mean(logs)), 6) if ws else None] += 1
    found = lm_scores.score(docs, bucket_chars=500).collect()
    assert Counter((r.doc_id, r.n_words, None if r.score is None else round(r.score, 6)) for r in found) == want
    assert lm_scores.score(none).count() == 0


def test_counts_in_bytes():
    counts = np.array([1, 254, 255, 256, 10**12, 0])
    assert (lm_scores.numbers(lm_scores.small_numbers(counts), 6) == counts).all()


def test_weak_labels(docs, rows, none):
    found = quality_classifier.classify(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in found)
    assert quality_classifier.classify(none).count() == 0
    patterns = np.array([[1, 1, 1], [-1, -1, 1], [1, -1, 1], [-1, -1, -1]])
    posterior, _ = quality_classifier.estimate(patterns, np.array([80.0, 15, 5, 10]))
    assert posterior[0] > 0.9 and posterior[3] < 0.1


def test_votes_and_posteriors_are_those_of_brute_force(spark, rows):
    import unicodedata
    extra = ["A1 b2! " * 30, "ǅ Σ ʰ ª 漢字 \U00010400 ́ ½ # " * 9, "", None, None]
    texts = [(r[0], r[1]) for r in rows] + [(10_000, text) for text in extra]

    def votes(text):
        text = text or ""
        kinds = [unicodedata.category(c) for c in text]
        words = WORD.findall(text)
        n, distinct, chars = len(words), len(set(words)), max(1, len(text))
        upper, letters = kinds.count("Lu"), sum(k[0] == "L" for k in kinds)
        ends = len(re.findall(r"[.!?](?=[ \t\n\x0b\f\r]|\Z)", text))
        symbols, digits = (sum(c in kept for c in text) for kept in ("#*$%&|<>", "0123456789"))
        per_word = letters / max(1, n)
        bad_good = [(symbols > 0.1 * n, symbols == 0), (upper > 0.5 * letters, upper < 0.2 * letters),
                    (n >= 20 and distinct < 0.2 * n, n >= 20 and distinct > 0.35 * n), (n < 5, n >= 50),
                    (n >= 20 and ends > 0.4 * n or text.count("!") > 0.1 * n, ends > 0.02 * n),
                    (per_word < 2 or per_word > 12, 3 <= per_word <= 10),
                    (digits > 0.2 * chars, digits < 0.05 * chars)]
        return tuple(0 if not n else -1 if bad else int(good) for bad, good in bad_good)

    found = quality_classifier.classify(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    expected = [votes(text) for _, text in texts]
    assert Counter((r.doc_id, tuple(r.votes)) for r in found) == Counter(zip([i for i, _ in texts], expected))
    good = {v: min(0.95, max(0.05, 0.5 + sum(v) / 14)) for v in expected}
    for _ in range(quality_classifier.ROUNDS):  # one document at a time, without logarithms
        mass = {c: [{-1: 1.0, 1: 1.0} for _ in range(7)] for c in (0, 1)}
        prior = {0: 1.0, 1: 1.0}
        for v in expected:
            for c, share in ((1, good[v]), (0, 1 - good[v])):
                prior[c] += share
                for h, vote in enumerate(v):
                    if vote:
                        mass[c][h][vote] += share
        like = {v: [prior[c] * np.prod([mass[c][h][x] / sum(mass[c][h].values()) for h, x in enumerate(v) if x])
                    for c in (0, 1)] for v in good}
        good = {v: both[1] / sum(both) for v, both in like.items()}
    for r in found:
        assert r.weak_label == pytest.approx(good[tuple(r.votes)], abs=1e-5)


def test_url_rules_and_templates(spark):
    urls = ["http://WWW.Example.COM/en/x?q", "http://a.example.com/en/", "http://net/fr/", "http://xnet/fr/",
            "a://b://c/d", "http://com", None, "nohost", "http://é.com/a\nb#x"]
    pages = [(i, u, None, "x") for i, u in enumerate(urls)]
    pages += [(first + i, f"http://host.org/{s}/{i}", int(s == "spam"), "x")
              for i in range(60) for first, s in ((100, "spam"), (200, "ham"))]
    frame = spark.createDataFrame(pages + pages[:1], "page_id long, url string, bad int, label string")
    found = {r.page_id: r for r in url_filters.filter_urls(frame).collect()}
    assert [(found[i].host, found[i].path, found[i].rule) for i in range(9)] == [
        ("www.example.com", "/en/x", "www.example.com/en/"), ("a.example.com", "/en/", "example.com/en/"),
        ("net", "/fr/", "net/fr/"), ("xnet", "/fr/", None), ("b:", "//c/d", None), ("com", "", None),
        ("", "", None), ("", "", None), ("é.com", "/a\nb", "com/")]
    assert found[1].verdict == found[2].verdict == "block" and found[0].verdict == "allow"
    assert found[100].template == "/spam/*" and found[100].verdict == "block"
    assert {r.verdict for r in found.values() if r.template == "/ham/*"} == {"allow"}
    assert url_filters.filter_urls(frame.filter("false")).count() == 0


def test_url_sections_part_at_the_fifth_segment(spark):
    pages = [(first + i, f"http://host.org/a/b/c/d/{s}/{i}", int(s == "spam"))
             for i in range(60) for first, s in ((100, "spam"), (200, "ham"))]
    pages.append((1, "http://lone.org/" + "/".join("xyz" * 20), None))
    frame = spark.createDataFrame(pages, "page_id long, url string, bad int")
    found = {r.page_id: r for r in url_filters.filter_urls(frame).collect()}
    assert len(found) == len(pages)
    assert {(r.template, r.verdict) for r in found.values() if r.page_id >= 200} == {("/a/b/c/d/ham/*", "allow")}
    assert {(r.template, r.verdict) for r in found.values() if 100 <= r.page_id < 200} == {
        ("/a/b/c/d/spam/*", "block")}
    assert found[1].template == "/" + "/".join("xyz" * 20)


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.RandomState(2)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(150)]
    vectors += [(150, vectors[3][1]), (151, vectors[3][1]), (160, None), (161, [float("nan")] * 6),
                (162, [None] * 6), (None, vectors[0][1]), (3, vectors[3][1])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in exact_top_k.top_k(
        frame, F.col("vec_id") % 20 == 0, k=7).collect())
    ids = np.array([i for i, v in vectors[:152]])
    x = np.floor(64 * np.array([v for _, v in vectors[:152]], np.float32).astype(float)).astype(int)
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        order = [j for j in np.lexsort((ids, -scores)) if j != q][:7]
        want += [(int(ids[q]), n + 1, int(ids[j]), int(scores[j])) for n, j in enumerate(order)]
    assert found == sorted(want)
    assert exact_top_k.top_k(frame.filter("false"), F.lit(True)).count() == 0


def test_pipeline_over_stages(spark, tmp_path, docs):
    folder = str(tmp_path)
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert pieces and {p.doc_id for p in pieces} <= {r.doc_id for r in docs.collect()}
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0
