"""BPE and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docspark.llm import bpe, token_files
from docspark.llm.queries import VOCABULARY, vocabulary

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("kind", [bpe.PairIndexBpe, token_files.LibraryEncoder])
def test_ids_equal_the_library(kind, library):
    letters = list("abtTsre'lmdv0123 \n\t\x1c.,!<|>éÉßΣσςİıǅﬀ̧́ａ１²५漢字😀​\xa0\x85") + ["<|endoftext|>", "'re", "'LL"]
    random = np.random.default_rng(3)
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(3000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}'s" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    encoder = kind(vocabulary())
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)] == wanted
    assert [encoder.decode(x) for x in wanted] == [library.decode(x, skip_special_tokens=False) for x in wanted]


def test_small_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 6)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 6)
    encoder = bpe.PairIndexBpe(vocabulary())
    texts = [f"the word{i % 7} in text{i % 5}" for i in range(50)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_and_decode_rows(odd, nothing, library):
    rows = bpe.decode_bpe(bpe.encode_bpe(odd, vocabulary()), vocabulary()).collect()
    assert len(rows) == odd.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_bpe(nothing, vocabulary(), decoded="decoded").count() == 0
    with pytest.raises(ValueError):
        bpe.encode_bpe(odd, vocabulary(), ids="Text")


def test_unknown_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([([320, 999_999, 320],), (None,), ([],)], "ids array<int>")
    found = [r.decoded for r in bpe.decode_bpe(df, vocabulary()).collect()]
    one = bpe.PairIndexBpe(vocabulary()).decode([320])
    assert found == [f"{one} {one}", "", ""]


def test_token_files_round_trip(spark, documents, odd, nothing, library):
    for docs in (documents.select("doc_id", "text"), odd, nothing):
        folder = token_files.token_folder(spark)
        manifest = token_files.write_token_files(docs, vocabulary(), folder, end_id=2, files=3)
        rows = token_files.read_token_files(spark, folder, manifest).collect()
        wanted = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
        rows.sort(key=lambda r: (r.start,))
        assert [r.doc_id for r in rows] == [r.doc_id for r in wanted]
        start = 0
        for r, w in zip(rows, wanted):
            ids = [*library.encode(w.text or "", add_special_tokens=False).ids, 2]
            assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
            start += len(ids)
        for m in manifest.where("docs > 0").collect():
            one = token_files.TokenFile(folder, m.file)
            assert one.ids(m.docs - 1)[-1] == 2
        raw = token_files.read_token_files(spark, folder, manifest, raw=True).collect()
        assert {zlib.crc32(r.ids) for r in raw} == {zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows}


def test_changed_dictionary_is_noticed(spark, documents, tmp_path):
    folder = str(tmp_path / "tokens")
    manifest = token_files.write_token_files(documents.select("doc_id", "text").limit(20), vocabulary(), folder, end_id=2, files=1)
    name = manifest.first().file
    trained = next(tmp_path.glob("tokens/*.dictionary"))
    assert hashlib.sha256(trained.read_bytes()).hexdigest() == trained.stem
    trained.write_bytes(b"other")
    with pytest.raises(ValueError, match="dictionary"):
        token_files.TokenFile(folder, name)
