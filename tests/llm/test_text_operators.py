import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from support import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from strataflow.llm import common, crf, fertility, nnpu, samples, winnow

MODEL = P.path("piece_bpe_32k.model")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


# ---------------------------------------------------------------- vectorised words

@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZ 09.é日\n\t_\x00🙂"), max_size=25)), max_size=6))
def test_words_and_hashes(texts):
    data, offsets = common.text_bytes(pa.array(texts, pa.string()))
    for kind, find, fold in ((common.ALNUM, ALNUM, True), (common.SPACED, SPACED, False)):
        w = common.Words(data, offsets, kind)
        found = [find.findall((t or "").translate(LOWER) if fold else t or "") for t in texts]
        assert w.counts.tolist() == [len(x) for x in found]
        flat = [x for f in found for x in f]
        raw = bytes(data)
        got = [raw[a:b].decode() for a, b in zip(w.begins, w.ends)]
        assert [g.translate(LOWER) if fold else g for g in got] == flat
        assert all((w.hashes[i] == w.hashes[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


def test_words_beyond_the_tables():
    long = "a" * 200_000
    w = common.Words(*common.text_bytes(pa.array([f"{long} b {long} {long[:-1]}"])))
    assert w.hashes[0] == w.hashes[2] != w.hashes[3] and len(w.hashes) == 4


def test_slices_cover_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 100, 3, 3, 3)])], ["text"])
    parts = list(common.slices(batch, "text", 6))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 3


# ---------------------------------------------------------------- decontamination

def brute_contamination(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for name, item in items:
        v = words(item)
        n = min(window, len(v))
        grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k : k + n]) in grams:
                hit.update(range(k, k + n))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def benchmark_rows():
    from llm_support import prose

    return [(1, prose(50, 30)), (2, prose(51, 12)), (2, prose(52, 9)), (3, "three short words"), (4, ""), (5, None), (None, prose(50, 30)), (10, prose(50, 30)), (11, prose(53, 10))]


def planted(benchmark_rows):
    from llm_support import prose

    full = words(benchmark_rows[0][1])
    nine, ten = " ".join(full[4:13]), " ".join(full[4:14]).upper()
    return [
        (1, prose(60, 100)), (2, f"{prose(61, 50)} {nine} {prose(62, 50)}"), (3, f"{prose(61, 50)} {ten} {prose(62, 50)}"), (4, benchmark_rows[0][1]), (5, "Three, short -- WORDS!"), (6, None), (7, ""),
        (8, f"{benchmark_rows[1][1]} x {benchmark_rows[2][1]}"), (9, prose(53, 10)), (9, prose(53, 10)), (None, ten), (12, " ".join([ten] * 200)), (13, "the " * 50),
    ]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_equals_brute_force(spark, benchmark_rows, block_bytes):
    docs = planted(benchmark_rows)
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    df = spark.createDataFrame([(k, t, "clash", 7) for k, t in docs], "doc_id long, text string, hit_items string, n_hit int")
    out = winnow.contamination(df, bench, block_bytes=block_bytes)
    items = [(k, t) for k, t in benchmark_rows if k is not None and t is not None]
    expected = sorted((d or 0, *brute_contamination(t, items)) for d, t in docs)
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.hit_items) for r in out.collect()) == expected


def test_contamination_of_and_by_nothing(spark, odd_docs, no_docs, benchmark_rows):
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    assert winnow.contamination_digests(no_docs, bench).count() == 0
    out = winnow.contamination_digests(odd_docs, bench.where("false")).collect()
    assert len(out) == odd_docs.count() and not any(r.contaminated for r in out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=60), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(0, 30))
def test_every_long_shared_stretch_is_found(doc, item, at):
    doc = doc[:at] + item[5:20] + doc[at:]
    index = winnow.Fingerprints([("i", " ".join(item))], 10, 5)
    hit, found = index.scan(common.Words(*common.text_bytes(pa.array([" ".join(doc)]))))
    _, n, names = brute_contamination(" ".join(doc), [("i", " ".join(item))])
    assert (int(hit.sum()), found[0]) == (n, names)


# ---------------------------------------------------------------- fertility rules

def brute_base(text):
    text = text or ""
    w = SPACED.findall(text)
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    twice = Counter(grams)
    repeated = {j for k, g in enumerate(grams) if twice[g] > 1 for j in range(k, k + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed


def test_base_counts_equal_brute_force(odd_docs, no_docs):
    out = fertility.quality_rules(odd_docs, MODEL)
    assert out.columns.count("n_words") == 1
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect())
    assert got == sorted((r.doc_id or 0, *brute_base(r.text)) for r in odd_docs.collect())
    assert not any(r.kept and r.base_failed for r in out.collect())
    assert fertility.quality_rules(no_docs, MODEL).count() == 0


def test_base_counts_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = fertility.quality_rules(docs.select("doc_id", "text"), MODEL, carry=["doc_id"])
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()}
    assert got == {r.doc_id: brute_base(r.text) for r in docs.collect()}


def test_bands_reject_what_the_vocabulary_cannot_read():
    from llm_support import prose

    texts = [prose(3, 80), " ".join("".join(chr(0x1F300 + (7 * k + j) % 500) for j in range(3)) for k in range(40)), " ".join(["§¶†‡" * 3] * 30), "", "привет мир это обычный русский текст про реку и лес"]
    tokens, share, entropy = fertility.token_figures(MODEL, texts)
    assert tokens[3] == 0 and share[0] < 0.3 and share[1] > 0.5 and 0 < entropy[0] <= 1
    assert fertility.base_counts(pa.array(texts))["scripts"].argmax(1).tolist()[-1] == fertility.SCRIPTS.index("cyrillic")


def test_bands_tell_symbols_and_table_cells_from_clean_texts(spark):
    folder = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null").select("doc_id", "quality")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id")
    for columns in (["doc_id", "quality", "text", "lang"], ["doc_id", "quality", "text"]):
        rows = fertility.quality_rules(docs.select(*columns), MODEL, carry=["doc_id", "quality"]).where("not base_failed").collect()
        bad, good = [r.kept for r in rows if r.quality == 0], [r.kept for r in rows if r.quality == 1]
        assert bad.count(False) >= (0.8 if "lang" in columns else 0.3) * len(bad) > 0
        assert good.count(True) >= 0.92 * len(good) > 0


VOCABULARIES = (MODEL, P.path("byte_bpe_50k.json"))


def test_measured_bands_reject_junk_and_keep_clean_texts(spark):
    folder = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    bands = fertility.fit_bands(docs, labels, VOCABULARIES)
    known = docs.join(labels.where("quality is not null").select("doc_id", "quality"), "doc_id").where(samples.held_out())
    rows = fertility.quality_rules(known, VOCABULARIES, bands, carry=["doc_id", "quality"]).where("not base_failed").collect()
    bad, good = [r.kept for r in rows if r.quality == 0], [r.kept for r in rows if r.quality == 1]
    assert bad.count(False) >= 0.7 * len(bad) > 0 and good.count(True) >= 0.97 * len(good) > 0


def brute_figures(path, text):
    """(tokens, characters per token, share of lone bytes, relative entropy) by the library itself."""
    import sentencepiece
    from tokenizers import Tokenizer

    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = model.encode(text)
        lone = sum(model.is_byte(k) for k in ids)
    else:
        model = Tokenizer.from_file(path)
        ids = model.encode(text, add_special_tokens=False).ids
        lone = sum("\ufffd" in model.decode([k]) for k in ids)
    if not ids:
        return 0, len(text), 0.0, 1.0
    p = np.array(list(Counter(ids).values())) / len(ids)
    return len(ids), len(text) / len(ids), lone / len(ids), -(p * np.log(p)).sum() / np.log(len(ids)) if len(ids) > 1 else 1.0


def test_verdicts_equal_brute_force(spark, odd_docs):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    bands = fertility.fit_bands(real, spark.read.parquet(f"{SF}/labels.parquet"), VOCABULARIES, least=10)
    docs = real.unionByName(odd_docs.select("doc_id", "text", "lang")).unionByName(spark.createDataFrame([(99, "ж" * 5 + " " + "река " * 30, "ru"), (98, "ok " * 40, "xx")], "doc_id long, text string, lang string"))
    got = {(r.doc_id, r.text): r for r in fertility.quality_rules(docs, VOCABULARIES, bands).collect()}
    verdicts = Counter()
    for r in docs.collect():
        text, row = r.text or "", got[r.doc_id, r.text]
        found = [brute_figures(path, text) for path in VOCABULARIES]
        counts = [sum(c.isascii() and c.isalpha() or "\x80" <= c < "\u0380" for c in text), *[sum(a <= c < b for c in text) for a, b in (("\u0380", "\u0400"), ("\u0400", "\u0500"), ("\u0500", "\u0800"), ("\u0800", "\U00010000"))], sum(c >= "\U00010000" for c in text)]
        script = fertility.SCRIPTS[counts.index(max(counts))]
        band = bands[r.lang if script == "latin" and r.lang in bands and r.lang not in fertility.SCRIPTS else script]
        size = (found[0][0] >= 150) + (found[0][0] >= 400)
        inside = True
        for k, (n, *figures) in enumerate(found):
            for j, x in enumerate(figures):
                low, high = band[size][3 * k + j]
                low *= np.log(4096) / np.log(max(n, 4096)) if j == 2 else 1
                inside &= low <= x <= high
                assert [row.chars_per_token, row.byte_share, row.token_entropy, row.chars_per_token_2, row.byte_share_2, row.token_entropy_2][3 * k + j] == pytest.approx(x)
        assert row.script == script and row.kept == (bool(inside) and not row.base_failed), (r.doc_id, found)
        verdicts[row.kept, row.base_failed] += 1
    assert verdicts[True, False] and verdicts[False, False] and verdicts[False, True]


def test_without_labels_every_band_is_open(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bands = fertility.fit_bands(no_docs, labels, VOCABULARIES)
    assert {x for found in bands.values() for size in found for x in size} == set(fertility.OPEN)
    assert fertility.quality_rules(odd_docs, VOCABULARIES, bands).count() == odd_docs.count()


def test_bands_reject_a_clean_text_once_it_is_dressed_as_symbols_or_cells(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    clean = fertility.quality_rules(docs, MODEL).where("kept and n_tokens >= 400").orderBy("doc_id").limit(20).collect()
    rows = []
    for r in clean:
        w = r.text.split()
        rows += [(r.doc_id, "symbols", " ".join(x + ("%%%", "$$$", "&&&")[k % 3] for k, x in enumerate(w)), "en"), (r.doc_id, "cells", " | ".join(w), "en")]
    out = fertility.quality_rules(spark.createDataFrame(rows, "doc_id long, kind string, text string, lang string"), MODEL).collect()
    kept = Counter(r.kind for r in out if r.kept)
    assert len(out) == 2 * len(clean) > 0 and not kept["symbols"] and kept["cells"] <= 0.15 * len(clean)


def test_longer_texts_need_no_more_bits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    clean = [r.text for r in fertility.quality_rules(docs, MODEL).where("kept").orderBy("doc_id").collect()]
    joined = spark.createDataFrame([("\n".join(clean), "en")], "text string, lang string")
    out = fertility.quality_rules(joined, MODEL).first()
    assert out.n_tokens > 2 * fertility.FULL and out.chars_per_token > 2.476 and (out.base_failed or out.kept)


def test_token_figures_of_long_texts_are_of_the_whole():
    from llm_support import prose

    text = prose(9, 30_000)
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text)
    tokens, _, entropy = fertility.token_figures(MODEL, [text])
    p = np.array(list(Counter(whole).values())) / len(whole)
    assert tokens[0] == len(whole) and entropy[0] == pytest.approx(-(p * np.log(p)).sum() / np.log(len(whole)))


# ---------------------------------------------------------------- classifiers

def test_forward_backward_equals_enumeration():
    import itertools

    draw = np.random.default_rng(1)
    sizes = [4, 1, 6]
    first = np.concatenate([[0], np.cumsum(sizes)])
    unary, pair = draw.normal(size=(sum(sizes), 2)), draw.normal(size=(2, 2))
    marginal, expected, log_z = crf.forward_backward(unary, pair, first)
    total = np.zeros((2, 2))
    for k, n in enumerate(sizes):
        u, weight, gold = unary[first[k] : first[k + 1]], 0.0, np.zeros((n, 2))
        pairs = np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(u[t, s] for t, s in enumerate(path)) + sum(pair[a, b] for a, b in zip(path, path[1:])))
            weight += w
            for t, s in enumerate(path):
                gold[t, s] += w
            for a, b in zip(path, path[1:]):
                pairs[a, b] += w
        np.testing.assert_allclose(marginal[first[k] : first[k + 1]], gold / weight, rtol=1e-9)
        assert log_z[k] == pytest.approx(np.log(weight))
        total += pairs / weight
    np.testing.assert_allclose(expected, total, rtol=1e-9)


def brute_line_features(texts):
    """Own features of each line as their names say, in the model's order, without arrays."""
    marks, symbols = ".,;:!?'\"()-", "#*$%&|<>{}[]=_/\\^~`@+"
    kinds = lambda b: 1 if 48 <= b < 58 else 2 if 65 <= b < 91 else 3 if 97 <= b < 123 or b >= 128 else 4 if chr(b) in marks else 5 if chr(b) in symbols else 6 if b in b" \t\r\n\x0b\x0c" else 0
    out = []
    for text in texts:
        lines, seen_lines, seen_words, last_word, own = (text or "").split("\n"), set(), set(), None, []
        for line in lines:
            raw = line.encode()
            counts = [sum(kinds(b) == k for b in raw) for k in range(crf.KINDS)]
            tokens, size = SPACED.findall(line), max(len(raw), 1)
            some = max(len(tokens), 1)
            again = adjacent = 0
            for token in tokens:
                again += token in seen_words
                adjacent += token == last_word
                seen_words.add(token)
                last_word = token
            bare = len(tokens) - min(len(words(line)), len(tokens))
            row = [c / size for c in counts] + [np.log1p(len(raw)) / 5, np.log1p(len(tokens)) / 4, len(raw) / some / 10, bare / some, line in seen_lines and line != "", again / some, adjacent / some]
            row += [raw[-1:] in (b".", b"!", b"?", b'"', b"'", b")") and raw != b"", bool(raw) and kinds(raw[-1]) == 5, not raw, min(counts[5] / some, 3)]
            seen_lines.add(line)
            own.append([float(x) for x in row])
        blank = [0.0] * crf.OWN
        out += [row + (own[k - 1] if k else blank) + (own[k + 1] if k + 1 < len(own) else blank) + [1.0, float(k == 0), float(k + 1 == len(own))] for k, row in enumerate(own)]
    return np.array(out)


def test_line_features_and_scores_equal_brute_force(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()]
    texts = [t if t and len(t) < 4000 else None for t in docs] + ["", "\n\n", "a a b\na a b\n\n###", "É | É |\n|"]
    features, weights, first = crf.line_features(pa.array(texts, pa.string()))
    np.testing.assert_allclose(features, brute_line_features(texts), atol=1e-12)
    assert weights.tolist() == [max(len(line.encode()), 1) for t in texts for line in (t or "").split("\n")]
    draw = np.random.default_rng(3)
    model = crf.LineModel(draw.normal(size=crf.WIDTH), draw.normal(size=(2, 2)), draw.normal(size=crf.WIDTH) / 10, 1 + draw.random(crf.WIDTH))
    scores = model.scores(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        unary = model.unary(features[first[k] : first[k + 1]])
        forward, backward, n = np.zeros((len(unary), 2)), np.zeros((len(unary), 2)), len(unary)
        forward[0] = unary[0]
        for t in range(1, n):
            forward[t] = [np.logaddexp.reduce(forward[t - 1] + model.pair[:, s]) + unary[t, s] for s in (0, 1)]
        for t in range(n - 2, -1, -1):
            backward[t] = [np.logaddexp.reduce(model.pair[s] + unary[t + 1] + backward[t + 1]) for s in (0, 1)]
        total = forward + backward
        good = np.exp(total[:, 1] - np.logaddexp(total[:, 0], total[:, 1]))
        weight = weights[first[k] : first[k + 1]]
        assert scores[k] == pytest.approx((good * weight).sum() / weight.sum(), abs=1e-9)


def test_training_takes_every_line():
    first, marks = crf.stretches(np.array([0, 5, 5, 305, 306]), np.array([0, 1, 1, 0]), 120)
    assert first.tolist() == [0, 5, 125, 245, 305, 306] and marks.tolist() == [0, 1, 1, 1, 0]
    assert crf.stretches(np.array([0]), np.array([], int), 120)[0].tolist() == [0]


def test_training_samples_are_bounded(spark):
    docs = spark.createDataFrame([(k, "x" * (10 if k % 3 else 5000) + "\n" * (k % 5)) for k in range(300)] + [(1, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(300)], "doc_id long, quality int, toxic int")
    rows = crf.training_rows(docs, labels, 100, 4000).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.quality] += len(r.text or "") + 64 * (1 + (r.text or "").count("\n"))
    assert 0 < sizes[0] <= 4000 and 0 < sizes[1] <= 4000 and all(len(r.text or "") < 100 for r in rows)


def test_line_features_survive_odd_texts(odd_docs):
    column = pa.array([r.text for r in odd_docs.collect()], pa.string())
    features, weights, first = crf.line_features(column)
    assert features.shape == (sum(len((t or "").split("\n")) for t in column.to_pylist()), crf.WIDTH) and np.isfinite(features).all()
    assert len(first) == len(column) + 1 and (weights >= 1).all()


def held_out_accuracy(spark, out, labels, column):
    rows = out.join(labels, "doc_id").where("held_out").collect()
    return len(rows), np.mean([r.predicted == r[column] for r in rows])


def test_quality_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    n, accuracy = held_out_accuracy(spark, crf.quality_scores(docs, labels), labels, "quality")
    assert n > 50 and accuracy > 0.95


def test_toxicity_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    n, accuracy = held_out_accuracy(spark, nnpu.toxicity_scores(docs, labels), labels, "toxic")
    assert n > 500 and accuracy > 0.96


def test_scores_have_no_other_inputs(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 0, 1), (9, 1, 0), (13, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for score in (crf.quality_scores, nnpu.toxicity_scores):
        out = score(odd_docs, labels).collect()
        assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
        same = {r.score for r in out if r.doc_id in (7, 8)}
        assert len(same) == 1  # equal texts, equal scores
        assert score(no_docs, labels).count() == 0
        assert score(odd_docs, labels.where("false")).count() == odd_docs.count()


def test_folds_follow_the_crc(spark):
    import zlib

    rows = spark.createDataFrame([(k,) for k in (0, 1, 17, 123456789, -4)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in rows.select("doc_id", samples.held_out().alias("h")).collect()}
    assert got.pop(None) is True and got == {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in got}


def test_negative_risk_is_not_driven_below_zero():
    draw = np.random.default_rng(0)
    toxic, clean = [np.array([7, *draw.integers(100, 5000, 20)], np.int64) for _ in range(200)], [draw.integers(100, 5000, 20) for _ in range(1800)]
    model = nnpu.fit_nnpu(toxic[:100], toxic[100:] + clean, 0.05)
    score = lambda sets: np.array([1 / (1 + np.exp(-(model.bias + sum(model.weights[model.place[b]] for b in set(s.tolist()) if model.place[b] >= 0)))) for s in sets])
    assert (score(toxic) >= 0.5).mean() > 0.95 and (score(clean) < 0.5).mean() > 0.95


def brute_buckets(text):
    """Buckets of a text's words and of the beginnings of its longer words, each hashed alone."""
    found = set()
    for word in words(text):
        w = common.Words(*common.text_bytes(pa.array([word])))
        found.add(int(w.hashes[0] >> common.U64(44)))
        for size in nnpu.STEMS:
            if len(word.encode()) > size:
                found.add(int(w.stems(size)[1][0] >> common.U64(44)))
    return found


def test_toxic_fit_and_scores_equal_brute_force(spark):
    """The fit in tasks against the same risk written out text by text."""
    import zlib

    folder = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").where("length(text) < 3000").orderBy("doc_id").limit(400)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = nnpu.train_toxicity(docs.repartition(3), labels, features=64, steps=8)
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    marks = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    texts = {r.doc_id: brute_buckets(r.text) for r in docs.collect()}
    prior = np.mean([v for k, v in marks.items() if not held(k)])
    positive = list({frozenset(b): b for k, b in texts.items() if marks.get(k) == 1 and not held(k)}.values())
    unlabelled = [b for k, b in texts.items() if not held(k)]
    in_p, in_u = Counter(x for b in positive for x in b), Counter(x for b in unlabelled for x in b)
    purity = {x: min(prior * (n + 0.5) / (len(positive) + 1) / ((in_u[x] + 0.5) / (len(unlabelled) + 1)), 1) for x, n in in_p.items() if n >= max(3, 0.002 * len(positive))}
    usable = sorted(x for x, p in purity.items() if p >= min(0.5, 3 * prior))
    chosen = sorted(usable, key=lambda x: (-(purity[x] * np.sqrt(in_p[x])), x))[:64]
    assert sorted(np.flatnonzero(model.place >= 0).tolist()) == sorted(chosen) and len(chosen) > 5
    w, b = {x: 1.0 for x in chosen}, -2.0
    moment, square = Counter(), Counter()
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for step in range(1, 9):
        def means(group, w=w, b=b):
            grad, total = Counter(), 0.0
            for buckets in group:
                s = sigmoid(sum(w[x] for x in buckets if x in w) + b)
                total += s / len(group)
                grad[None] += s * (1 - s) / len(group)
                for x in buckets:
                    if x in w:
                        grad[x] += s * (1 - s) / len(group)
            return total, grad

        (p, p_grad), (u, u_grad) = means(positive), means(unlabelled)
        for x in [*chosen, None]:
            negative = u_grad[x] - prior * p_grad[x]
            g = -negative if u - prior * p < 0 else negative - prior * p_grad[x]
            g += 1e-4 * w[x] if x is not None else 0
            moment[x] = 0.9 * moment[x] + 0.1 * g
            square[x] = 0.999 * square[x] + 0.001 * g * g
            move = 0.3 * (moment[x] / (1 - 0.9**step)) / (np.sqrt(square[x] / (1 - 0.999**step)) + 1e-8)
            if x is None:
                b -= move
            else:
                w[x] -= move
    assert model.bias == pytest.approx(b, abs=1e-6) and all(model.weights[model.place[x]] == pytest.approx(w[x], abs=1e-6) for x in chosen)
    out = {r.doc_id: r.score for r in nnpu.score_toxicity(docs, model).collect()}
    assert all(out[k] == pytest.approx(sigmoid(sum(w[x] for x in buckets if x in w) + b), abs=1e-6) for k, buckets in texts.items())


def test_bands_are_of_all_clean_texts_and_at_exact_quantiles(spark, odd_docs):
    few = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(60).collect()]
    n = 9000  # more than a sample of 6,000 would hold; the last of each text's variants is an outlier
    rows = [(k, "fr" if k % 3 else "en", f"{' '.join((few[k % 60] or 'x').split()[:40])} {'the of and to in' if k % 500 else '%%% $$$ &&& ###'} w{k}") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(n)], "doc_id long, quality int, toxic int")
    bands = fertility.fit_bands(docs, labels, VOCABULARIES)
    known = fertility._measured(docs, VOCABULARIES, ["doc_id", "lang"]).where(~samples.held_out()).where("not base_failed").collect()
    assert len(known) > 6000
    for lang in ("en", "fr"):
        of = [r for r in known if r.lang == lang and r.script == "latin" and r.n_tokens < 150]
        figures = np.array([x for _, x in sorted({(r.n_tokens, tuple(r._levels)) for r in of})])
        for q in fertility.QUANTILES:
            ends = np.quantile(figures, [q, 1 - q], axis=0)
            if ((figures >= ends[0]) & (figures <= ends[1])).all(1).mean() >= 0.99:
                break
        slack = (ends[1] - ends[0]) / np.sqrt(len(figures))
        want = np.stack([ends[0] - slack, ends[1] + slack], 1)
        want[1::3, 0], want[2::3, 1] = 0.0, 1.0
        np.testing.assert_array_equal(np.array(bands[lang][0]), want)


def test_rules_fitted_and_given_at_once_equal_those_by_given_bands(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").unionByName(odd_docs.select("doc_id", "text", "lang"))
    docs = docs.unionByName(docs.limit(20)).withColumn("kept", F.lit("other")).withColumn("more", F.col("doc_id") + 1)
    for frame in (docs, docs.drop("lang"), no_docs):
        for carry in (None, ["doc_id"]):
            by_bands = fertility.quality_rules(frame, VOCABULARIES, fertility.fit_bands(frame, labels, VOCABULARIES), carry)
            at_once = fertility.fitted_rules(frame, labels, VOCABULARIES, carry)
            assert at_once.columns == by_bands.columns and sorted(map(str, at_once.collect())) == sorted(map(str, by_bands.collect()))
