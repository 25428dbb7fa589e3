import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataflow.llm import bpe, common, pieces, sequences, tokens
from strataflow.llm.common import safe_pieces

JSON, MODEL, RANKS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = st.text(st.sampled_from("aab 日é ß\u0085\x1c🙂\n\t 'strevlmd012²¼#$%the_\xa0µ×÷ªЖжΩ–€ǅ̃"), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- counts

def test_counts_equal_the_library(spark, odd_docs, library):
    out = tokens.count_tokens(odd_docs, JSON).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_bytes, r.over_limit) for r in out) == sorted((r.doc_id or 0, n := len(ids_of(library, r.text)), len((r.text or "").encode()), n > 512) for r in odd_docs.collect())


@pytest.mark.parametrize("path", [P.path("word_bpe_49k.json"), MODEL])
def test_other_vocabularies(spark, odd_docs, path):
    out = {(r.doc_id, r.n_tokens) for r in tokens.count_tokens(odd_docs.where("doc_id in (1, 7, 9)"), path).collect()}
    if path == MODEL:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert out == {(r.doc_id, len(model.encode(r.text))) for r in odd_docs.where("doc_id in (1, 7, 9)").collect()}
    else:
        other = Tokenizer.from_file(path)
        assert out == {(r.doc_id, len(other.encode(r.text, add_special_tokens=False).ids)) for r in odd_docs.where("doc_id in (1, 7, 9)").collect()}


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_cut_texts_have_the_same_tokens(parts):
    library = Tokenizer.from_file(JSON) if not hasattr(test_cut_texts_have_the_same_tokens, "lib") else test_cut_texts_have_the_same_tokens.lib
    test_cut_texts_have_the_same_tokens.lib = library
    text = " ".join(parts)
    pieces = safe_pieces(text, 5)
    assert "".join(pieces) == text
    assert sum(len(ids_of(library, p)) for p in pieces) == len(ids_of(library, text))


@given(st.lists(st.integers(0, 100), max_size=60), st.integers(1, 200))
def test_batches_are_balanced(sizes, limit):
    batches = tokens.balanced(sizes, limit)
    assert sorted(k for b in batches for k in b) == list(range(len(sizes)))
    sums = [sum(sizes[k] for k in b) for b in batches]
    assert not sizes or max(sums) <= max(limit, sum(sizes) / len(sums)) + max(sizes)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab ▁\n\té日🙂 \x00<0>ﬁ_"), max_size=30), max_size=4))
def test_pieces_of_words_are_the_texts_pieces(texts):
    encoder = pieces.load_pieces(MODEL)
    assert [np.frombuffer(x, encoder.kind).tolist() for x in encoder.packed(texts)] == encoder.model.encode(texts)


def test_what_workers_remember_is_bounded():
    asked = []
    memo = common.Memo(lambda words: asked.append(len(words)) or [w.encode() for w in words], 10_000)
    for k in range(200):
        words = {f"w{k}", f"v{k % 7}", "x" * 5000}
        memo.know(words)
        assert all(memo[w] == w.encode() for w in words) and memo.held <= 10_000 and len(memo) < 60
    assert 400 <= sum(asked) < 200 * 3  # the long word each time, the others once in a while


def test_what_a_worker_remembers_in_all_is_bounded():
    learn = lambda words: [w.encode() for w in words]
    answers = {k: True for k in range(20)}
    rules, codec = common.Memo(learn, 20_000), common.Memo(learn, 10_000, beside=answers)
    for k in range(60):  # a stage that fills its memory, and the next one with another vocabulary
        rules.know({f"w{k}", "x" * 5000})
    assert len(rules) == 61 and rules.held > 10_000
    codec.know({"a", "b"})
    assert not rules and not rules.held and codec["a"] == b"a" and len(answers) == 20
    for k in range(85):
        rules.know({f"w{k}", "x" * 5000})
        assert rules[f"w{k}"] == f"w{k}".encode() and rules.all_held() + codec.all_held() <= 20_000
    assert not codec and not answers and len(rules) > 80  # what comes back is learnt again
    codec.know({"a"})
    codec.know({"a"})
    assert codec["a"] == b"a" and not rules


def test_nothing_to_count(no_docs):
    assert tokens.count_tokens(no_docs, JSON).collect() == []


# ---------------------------------------------------------------- byte-level BPE

@settings(max_examples=1500, deadline=None)
@given(TEXTS)
def test_encoding_equals_rank_ordered_merging(text):
    codec = bpe.load_codec(RANKS, P.PATTERN)
    own = test_encoding_equals_rank_ordered_merging
    own.ref = getattr(own, "ref", None) or tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert codec.encode(text) == own.ref.encode_ordinary(text)
    assert codec.decode_packed(codec.encode_packed(text)) == text.encode()


def test_every_vocabulary_entry_and_random_bytes():
    codec = bpe.load_codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    draw = random.Random(5)
    keys = list(codec.ranks)
    for _ in range(3000):
        word = b"".join(draw.choices(keys, k=draw.randint(1, 4)))
        try:
            text = word.decode()
        except UnicodeDecodeError:
            continue
        assert codec.encode(text) == ref.encode_ordinary(text)


def test_long_words_take_linear_time():
    codec = bpe.load_codec(RANKS, P.PATTERN)
    assert codec.decode_packed(codec.encode_packed("ab" * 100_000)) == b"ab" * 100_000


def test_digests(odd_docs, reference):
    expected = []
    for r in odd_docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        expected.append((r.doc_id or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    out = bpe.codec_digests(odd_docs, RANKS, P.PATTERN, carry=["doc_id"])
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()) == sorted(expected)


def test_ids_replace_a_column_of_that_name(odd_docs, no_docs):
    out = bpe.encode_documents(odd_docs, RANKS, P.PATTERN)
    assert dict(out.dtypes)["ids"] == "binary" and out.where("doc_id = 2").first().ids == b""
    assert bpe.encode_documents(no_docs, RANKS, P.PATTERN).count() == 0


# ---------------------------------------------------------------- sequences

def test_word_memo_equals_the_library(library):
    encoder = sequences.WordEncoder(JSON)
    draw = random.Random(3)
    pool = ["the", " river", "<|endoftext|>", "  ", "\n", "'s", "é", "日", "½", "\u0085", "_", " a", "0", "🙂"]
    texts = ["".join(draw.choices(pool, k=draw.randint(0, 12))) for _ in range(2000)]
    assert encoder.packed(texts) == [np.array(ids_of(library, t), "<u2").tobytes() for t in texts]


def test_files_are_random_access(tmp_path, library):
    docs = [list(range(10)), [2], list(range(100, 125))]
    raw = sequences.arrow_file(np.array(sum(docs, []), "<u2"), np.array([len(d) for d in docs]), pa.array([5, None, 9]), 8, (0, 0), batch_rows=2)
    (tmp_path / "f.arrow").write_bytes(raw)
    with pa.memory_map(str(tmp_path / "f.arrow")) as source:
        file = sequences.SequenceFile(source)
        assert file.reader.schema.field("ids").type == pa.list_(pa.uint16(), 8)
        assert [(n, size, crc) for n, size, crc in file.documents()] == [(n, len(d), zlib.crc32(struct.pack(f"<{len(d)}I", *d))) for n, d in zip((5, None, 9), docs)]
        flat = sum(docs, [])
        before = pa.total_allocated_bytes()
        column = file.reader.get_batch(1).column("ids")
        assert column.values[column.offset * 8 + 3].as_py() == flat[19]
        assert pa.total_allocated_bytes() == before  # nothing was copied


def test_round_trip(odd_docs, library):
    out = sequences.sequence_round_trip(odd_docs, JSON, length=64).collect()
    order = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    expected, start = [], 0
    for r in order:
        ids = [*ids_of(library, r.text), 2]
        expected.append((start, r.doc_id, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == expected


def test_small_files_keep_the_order(spark, tmp_path, odd_docs, library):
    sequences.write_sequences(odd_docs, JSON, str(tmp_path / "s"), length=16, file_tokens=50)
    rows = sequences.sequence_index(spark, str(tmp_path / "s")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd_docs.collect()), key=lambda x: (x is not None, x))
    assert len(list((tmp_path / "s").glob("part-*"))) > 3


def test_starts_add_up_over_groups_of_parts(spark, tmp_path, odd_docs, monkeypatch):
    monkeypatch.setattr(sequences, "PARTS", 2)
    sequences.write_sequences(odd_docs.repartitionByRange(7, "doc_id"), JSON, str(tmp_path / "s"), length=16, file_tokens=50)
    rows = sequences.sequence_index(spark, str(tmp_path / "s")).orderBy("start").collect()
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))] and len(rows) == odd_docs.count()


def test_nothing_to_write(no_docs):
    assert sequences.sequence_round_trip(no_docs, JSON).collect() == []
