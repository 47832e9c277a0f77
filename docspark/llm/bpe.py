"""Byte-pair encoding and decoding on a partition-wide pair occurrence index.

The unknown words of a step are laid out in one array of symbols. An index maps each rank that
occurs to all positions of its pair; ranks leave a heap in ascending order, every position of the
rank is merged, and the lists of the neighbouring pairs get the new positions. A word's ids are
kept, so each distinct word is merged once per worker and step.

Cases: null texts and empty texts have no ids; ids that the vocabulary lacks decode to nothing;
texts of any length are encoded whole; repeated rows give repeated results; other columns pass.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Regex, normalizers, pre_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docspark.llm.batches import list_array, put, steps

#: Chunks and words whose ids a worker remembers, in two generations: when the younger is full it
#: becomes the older one. Results do not depend on it.
KNOWN_CHUNKS, KNOWN_WORDS = 600_000, 600_000

#: Code points from here on are split by the tokenizer library's own tables: which of them are
#: letters or numbers differs between versions of Unicode.
VERSIONED = "\u0530"

# Separators that Python's str.split knows and the tokenizer's \s does not.
_INFORMATION_SEPARATORS = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def chunks(text: str) -> list[str]:
    """Runs of text between white space as the tokenizer sees it; no id ever crosses one."""
    if _INFORMATION_SEPARATORS.search(text):
        return [x for x in _SPACE.split(text) if x]
    return text.split()


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(shifted)) for b in range(256)]


class Memory:
    """What was found lately. ``known`` is the younger generation, which holds all of the current step."""

    def __init__(self, size: int) -> None:
        self.half = size // 2
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """Bring ``wanted`` into ``known`` where it is remembered; return the rest."""
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > self.half:
            self.older, self.known = self.known, {}
            new = wanted
        back = self.older.keys() & new
        self.known.update((w, self.older[w]) for w in back)
        return list(new.difference(back))


class WordEncoder:
    """A tokenizer file (NFC, lower case, split by pattern, byte level, BPE with a word end).

    Finds the words of a text and remembers their ids; ``merge`` of a subclass finds the ids of new words.
    """

    def __init__(self, definition: bytes) -> None:
        spec = json.loads(definition)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed":
            raise ValueError("not a lower-case word BPE definition")
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(split["pattern"]["Regex"])
        self.library_words = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
        self.library_normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.token_list = [self.tokens.get(i) for i in range(max(self.tokens) + 1)]
        self.chunks, self.words_seen = Memory(KNOWN_CHUNKS), Memory(KNOWN_WORDS)

    def merge(self, words: list[str]) -> list[bytes]:
        raise NotImplementedError

    def split(self, chunk: str) -> list[str]:
        """Words of a chunk, in normal form and lower case."""
        if chunk.isascii():
            return self.words.findall(chunk.lower())
        if max(chunk) >= VERSIONED:
            return [w for w, _ in self.library_words.pre_tokenize_str(self.library_normal.normalize_str(chunk))]
        # Each capital sigma becomes the same small one, wherever it stands in the word.
        return self.words.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())

    def parts(self, chunk: str) -> Iterator[tuple[str, bool]]:
        """Pieces of a chunk, and whether each is a special token."""
        if self.specials is None or "<" not in chunk:
            for word in self.split(chunk):
                yield word, False
            return
        for i, part in enumerate(self.specials.split(chunk)):
            if i % 2:
                yield part, True
            else:
                for word in self.split(part):
                    yield word, False

    def chunks_of(self, text: str) -> list[str]:
        """Chunks of a text, in lower case already where that is sure to be what the file means."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return chunks(text)
        return chunks(text if self.specials and self.specials.search(text.lower()) else text.lower())

    def learn(self, unknown: list[str]) -> None:
        """Find the ids of chunks that are not remembered."""
        split = [(chunk, list(self.parts(chunk))) for chunk in unknown]
        new = self.words_seen.missing({w for _, parts in split for w, special in parts if not special})
        pieces = self.words_seen.known
        pieces.update(zip(new, self.merge(new)))
        for chunk, parts in split:
            self.chunks.known[chunk] = b"".join([
                np.int32(self.special[w]).tobytes() if special else pieces[w] for w, special in parts])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.chunks_of(t) if t else [] for t in texts]
        seen: set[str] = set()
        for words in split:
            seen.update(words)
        self.learn(self.chunks.missing(seen))
        find = self.chunks.known.__getitem__
        return [b"".join(map(find, words)) for words in split]

    def decode(self, ids: list[int]) -> str:
        """Tokens of ids, one blank between them; ids without a token are left out."""
        try:
            return " ".join(map(self.token_list.__getitem__, ids))
        except (IndexError, TypeError):
            return " ".join(filter(None, map(self.tokens.get, ids)))


class PairIndexBpe(WordEncoder):
    """New words are merged together by an index of their pairs."""

    def __init__(self, definition: bytes) -> None:
        super().__init__(definition)
        # (left id, right id) as one number -> rank, and rank -> merged id
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(json.loads(definition)["model"]["merges"]):
            self.ranks.setdefault(self.ids[a] << 32 | self.ids[b], rank)
            self.merged.append(self.ids[a + b])
        alphabet = byte_alphabet()
        self.byte_ids = [self.ids[x] for x in alphabet]
        self.last_ids = [self.ids[x + self.end] for x in alphabet]

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word, all words merged together rank by rank."""
        inner, last, ranks = self.byte_ids, self.last_ids, self.ranks
        symbols: list[int] = []
        starts = []
        for word in words:
            data = word.encode()
            starts.append(len(symbols))
            symbols += [inner[b] for b in data[:-1]]
            symbols.append(last[data[-1]])
            symbols.append(-1)  # between words
        size = len(symbols)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        places: dict[int, list[int]] = {}
        find = ranks.get
        for at, (a, b) in enumerate(zip(symbols, symbols[1:])):
            if a >= 0 and b >= 0 and (rank := find(a << 32 | b)) is not None:
                if rank in places:
                    places[rank].append(at)
                else:
                    places[rank] = [at]
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            new = self.merged[rank]
            found = places.pop(rank)
            found.sort()  # from the left, as overlapping pairs need it
            for at in found:
                a = symbols[at]
                if a < 0:
                    continue
                right = after[at]
                b = symbols[right] if right < size else -1
                if b < 0 or find(a << 32 | b) != rank:
                    continue
                symbols[at], symbols[right] = new, -2
                nxt = after[right]
                after[at] = nxt
                if nxt < size:
                    before[nxt] = at
                    c = symbols[nxt]
                    if c >= 0 and (r := find(new << 32 | c)) is not None:
                        if r in places:
                            places[r].append(at)
                        else:
                            places[r] = [at]
                            heapq.heappush(active, r)
                prev = before[at]
                if prev >= 0:
                    c = symbols[prev]
                    if c >= 0 and (r := find(c << 32 | new)) is not None:
                        if r in places:
                            places[r].append(prev)
                        else:
                            places[r] = [prev]
                            heapq.heappush(active, r)
        flat = np.array(symbols, np.int32)
        cut = np.append(starts, size)
        keep = flat >= 0
        lengths = np.add.reduceat(keep, cut[:-1]) if len(words) else np.zeros(0, int)
        out, at = flat[keep].tobytes(), 0
        result = []
        for n in lengths.tolist():
            result.append(out[at:at + 4 * n])
            at += 4 * n
        return result


@lru_cache(maxsize=1)
def tokenizer_of(definition: bytes) -> PairIndexBpe:
    """One tokenizer per worker, with what it remembers from earlier partitions."""
    return PairIndexBpe(definition)


def read_definition(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {name} already: name another for the output")
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode_bpe(
    df: DataFrame, definition: bytes, text: str = "text", ids: str = "ids", decoded: str | None = None,
) -> DataFrame:
    """Append ``ids`` (array of int) of the whole ``text``. The definition travels as a broadcast of file size.

    With ``decoded``, the ids are decoded in the same pass too, into a column of that name.
    """
    schema = _with(df, ids, T.ArrayType(T.IntegerType()))
    if decoded:
        schema = T.StructType([*schema.fields, T.StructField(decoded, T.StringType())])
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer_of(shared.value)
        for batch, texts in steps(batches, text, 2_000_000):
            found = bpe.encode(texts)
            made = {ids: list_array(np.frombuffer(b"".join(found), np.int32), [len(x) // 4 for x in found], pa.int32())}
            if decoded:
                made[decoded] = pa.array([bpe.decode(np.frombuffer(x, np.int32).tolist()) for x in found], pa.string())
            yield put(batch, arrow, **made)

    return df.mapInArrow(run, schema)


def decode_bpe(df: DataFrame, definition: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append ``decoded``: the tokens of ``ids``, special ones too, joined by one space."""
    schema = _with(df, decoded, T.StringType())
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer_of(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                lists = part.column(part.schema.get_field_index(ids)).fill_null([])
                flat, cut = lists.flatten().to_numpy(zero_copy_only=False).tolist(), np.append(0, np.cumsum(lists.value_lengths()))
                texts = [bpe.decode(flat[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield put(part, arrow, **{decoded: pa.array(texts, pa.string())})

    return df.mapInArrow(run, schema)
