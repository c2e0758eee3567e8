"""Byte-pair encoding and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarrysift.llm import bpe, tokenfiles
from quarrysift.llm.tokenfiles import SequenceReader, open_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "abc  \n\t's'reLLdé ñ0123!?.,  漢字🙂'''ts ve\x1c\x85"
ODD = [
    None, "", " ", "\n\n x", "it's we're'll'' 's \n's", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
    "a" * 3000, " " * 500, "ab" * 4000, "՘࢏", "A" * 60 + "!" * 60,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def some_texts():
    random.seed(4)
    return ODD + ["".join(random.choices(LETTERS, k=random.randint(0, 80))) for _ in range(3000)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_speculation_gives_the_library_s_ids(library):
    texts = some_texts()
    _, encoder, decoder = bpe.speculative(PATH)
    ids, counts = encoder.encode(texts)
    ends = np.append(0, np.cumsum(counts))
    for k, text in enumerate(texts):
        own = ids[ends[k] : ends[k + 1]]
        assert own.tolist() == ids_of(library, text), text
        assert bpe.readable(decoder.decode(own)[0].tobytes()).decode() == library.decode(own.tolist(), skip_special_tokens=False)
    encoder.forget()
    again, _ = encoder.encode(texts[::-1])
    assert len(again) == len(ids)


def test_pairs_hold_if_they_are_their_own_encoding(library):
    vocabulary, _, _ = bpe.speculative(PATH)
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 50000, (2, 3000))
    holds = vocabulary.pairs_hold(left, right)
    for a, b, held in zip(left.tolist(), right.tolist(), holds.tolist()):
        raw = vocabulary.texts[a] + vocabulary.texts[b]
        # Merging the bytes alone: the library would also split them by its pattern.
        assert (vocabulary.merge_one(raw) == [a, b]) == held


def test_long_and_short_merges_agree():
    vocabulary, _, _ = bpe.speculative(PATH)
    random.seed(5)
    words = ["".join(random.choices("abehinort", k=random.randint(1, 40))).encode() for _ in range(500)]
    text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    end = np.cumsum([len(w) for w in words])
    ids, counts = vocabulary.merge(text, end - [len(w) for w in words], end)
    for w, part in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == vocabulary.merge_one(w)


def odd_table(spark, extra=""):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(1, "", "y"), (None, "no id", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_encode_decode_and_digests(spark, library):
    docs = odd_table(spark)
    coded = bpe.encode(docs, PATH)
    assert coded.columns == ["doc_id", "n_tokens", "tokens"]
    assert sorted(len(r.tokens) for r in coded.collect()) == sorted([len(ids_of(library, t)) for t in ODD] + [0, 2])
    texts = {r.doc_id: r.text for r in bpe.decode(coded, PATH).collect()}
    assert all(texts[k] == (t or "") for k, t in enumerate(ODD))
    rows = bpe.round_trip(docs, PATH).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else ODD[r.doc_id] or ""
        ids = ids_of(library, text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []


def test_sequence_files(spark, library, tmp_path):
    folder = str(tmp_path / "files")
    manifest = tokenfiles.write_sequences(odd_table(spark), PATH, folder, length=8)
    found = sorted(tokenfiles.read_documents(manifest).collect(), key=lambda r: r.start)
    place = 0
    ids_in_order = []
    for r in found:
        ids = [*ids_of(library, "no id" if r.doc_id is None else ODD[r.doc_id]), 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        place += len(ids)
        ids_in_order += ids
    keys = [r.doc_id for r in found]
    assert keys == [None, *sorted(k for k in keys if k is not None)] and len(keys) == len(ODD) + 2
    rows = tokenfiles.read_sequences(manifest).orderBy("file", "row").collect()
    starts = {r.file: r.start for r in manifest.collect()}
    rows.sort(key=lambda r: (starts[r.file], r.row))
    assert [i for r in rows for i, m in zip(r.ids, r.mask) if m] == ids_in_order
    assert all(len(r.ids) == len(r.mask) == 8 for r in rows)
    entry = manifest.first()
    store, root = open_folder(entry.folder)
    reader = SequenceReader(store, f"{root}/{entry.file}")
    ids, mask = reader.sequence(0)
    assert len(ids) == 8 and ids.to_pylist() == reader.file.get_batch(0).column(0)[0].as_py()
    with pytest.raises(ValueError, match="after the stream"):
        list(reader.stream(entry.ids - 1, 2))


def test_empty_sequence_table(spark, tmp_path):
    manifest = tokenfiles.write_sequences(odd_table(spark).limit(0), PATH, str(tmp_path / "none"))
    assert tokenfiles.read_documents(manifest).collect() == []
