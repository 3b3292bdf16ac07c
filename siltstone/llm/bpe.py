"""Byte-level BPE encoding and decoding through a table of distinct words.

Texts are split into words by the tokenizer's own pattern, in blocks. What is a letter or a
number follows the library's Unicode version: characters beyond Armenian are looked up in
the library once each, and those that it tells apart otherwise than the pattern's engine
are read as a character of their class. Each block asks
for its distinct words; requests meet by hash, so every distinct word of the corpus is
encoded once; the ids go back to the blocks that asked and are joined to the words by
position. Decoding is a join of ids with the table of pieces (id, piece): that table is
the tokenizer's vocabulary, whatever the corpus, so it is broadcast and hash-joined.

The tokenizer file says how texts are split. Byte-level files without a normalizer are
understood; any other setting raises ValueError rather than give other ids.

Results for odd input: a null text is an empty one, with no ids; a null id stays null;
repeated rows each get a result; an empty table gives no rows. Columns besides id and
text are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm._repeats import batch, get, put, split_contents
from siltstone.llm._scratch import ids_column, pack, trimmed, unpack, with_replies

#: The pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASKED = [("part", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())]
#: Of text in a block; only SLICE_BYTES of it are Python strings at a time.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 19
TOLD = [("block", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary: itself if printable, else one from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def check(spec: dict) -> None:
    """Whether a tokenizer file is one whose ids this module gives."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = all(not t.get(flag) for t in spec.get("added_tokens", ()) for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    rules = {
        "model BPE without unknown token, suffix or dropout": model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")),
        "no normalizer": not spec.get("normalizer"),
        "ByteLevel pre-tokenizer with its own pattern and no space before": split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True),
        "ByteLevel decoder": (spec.get("decoder") or {}).get("type") == "ByteLevel",
        "added tokens matched as they are": plain,
    }
    if broken := [rule for rule, holds in rules.items() if not holds]:
        raise ValueError(f"this tokenizer file needs: {'; '.join(broken)}")


class Classes:
    """Characters that the library puts in another class (letter, number, other) than the engine of the pattern. All below FIRST agree, and so does white space."""

    FIRST = 0x558
    LEAD = chr(FIRST).encode()[0]

    def __init__(self) -> None:
        import regex

        self.letter, self.number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
        self.known: set[str] = set()
        self.odd: dict[int, str] = {}

    @cached_property
    def library(self):
        from tokenizers import pre_tokenizers

        return pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def _with(self, mark: str, chars: list[str]) -> set[str]:
        """Those of chars that the library leaves in one word with a mark before them."""
        pieces = self.library.pre_tokenize_str("".join(f"{mark}{c}\n" for c in chars))
        return {chars[a // 3] for _, (a, z) in pieces if a % 3 == 0 and z - a >= 2}

    def stand_ins(self, text: str) -> dict[int, str]:
        """For odd characters of a text one that the engine puts in the right class: x, 1 or a dot, which begin no contraction."""
        chars = {c for c in set(text) if ord(c) >= self.FIRST}
        new = sorted(c for c in chars - self.known if not c.isspace())
        self.known |= chars
        if new:
            letters, numbers = self._with("a", new), self._with("1", new)
            for c in new:
                ours = "x" if self.letter.match(c) else "1" if self.number.match(c) else "."
                theirs = "x" if c in letters else "1" if c in numbers else "."
                if ours != theirs:
                    self.odd[ord(c)] = theirs
        return {ord(c): self.odd[ord(c)] for c in chars if ord(c) in self.odd}


class Vocabulary:
    """A tokenizer file of the byte-level kind: words to ids, ids to bytes."""

    def __init__(self, path: str) -> None:
        import regex

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check(spec)
        self.letters = byte_letters()
        of = {c: b for b, c in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = 1 + max([*spec["model"]["vocab"].values(), *self.special.values()])
        self.id_type = np.dtype(np.uint16 if n <= 1 << 16 else np.int32)
        pieces = {i: bytes(of[c] for c in piece) for piece, i in spec["model"]["vocab"].items()} | {i: piece.encode() for piece, i in self.special.items()}
        self.pieces = pa.table({"id": pa.array(list(pieces), pa.int32()), "piece": pa.array(list(pieces.values()), pa.binary())})
        self.words = regex.compile(PATTERN)
        self.classes = Classes()
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    @cached_property
    def model(self):
        """Loaded only where words are encoded."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).model

    def split(self, text: str, plain: bool = False) -> list[str]:
        """Words and special tokens of a text, in order; joined they are the text. plain: it has no character from Classes.FIRST on."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._words(text, plain)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self._words(text[at : m.start()], plain)
            out.append(m[0])
            at = m.end()
        return out + self._words(text[at:], plain)

    def _words(self, text: str, plain: bool) -> list[str]:
        swap = {} if plain else self.classes.stand_ins(text)
        if not swap:
            return self.words.findall(text)
        return [text[m.start() : m.end()] for m in self.words.finditer(text.translate(swap))]

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for t in self.model.tokenize("".join([self.letters[b] for b in word.encode()]))]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Numbers(dict):
    """Numbers words in the order of their first mention."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def slices(texts: list[bytes]):
    """Ranges of texts of about SLICE_BYTES."""
    a = size = 0
    for z, t in enumerate(texts):
        if z > a and size + len(t) > SLICE_BYTES:
            yield a, z
            a, size = z, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def distinct_words(v: Vocabulary, texts: list[bytes], parts: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Words of the texts as numbers and how many each text has; distinct words by part, else in order of their first mention; where each part begins and the end; the place of each number in that order."""
    numbers = Numbers()
    codes, n_words = [np.empty(0, np.int32)], []
    for a, z in slices(texts):
        for t in texts[a:z]:
            words = v.split(t.decode("utf-8", "replace"), not t or np.frombuffer(t, np.uint8).max() < Classes.LEAD)
            n_words.append(len(words))
            codes.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        codes = [np.concatenate(codes)]
    seen = list(numbers)
    part = np.fromiter((zlib.crc32(w.encode()) for w in seen), np.int64, len(seen)) % parts
    order = np.argsort(part, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return codes[0], np.array(n_words, np.int64), [seen[i] for i in order.tolist()], np.searchsorted(part[order], np.arange(parts + 1)), place


def ask(path: str, parts: int):
    def run(batches):
        v = vocabulary(path)
        for rb in batches:
            for block, ids, lens, body in zip(*(rb.column(c).to_pylist() for c in ("block", "ids", "lens", "body")), strict=True):
                _, _, words, cut, _ = distinct_words(v, unpack(ids, lens, body)[1], parts)
                raw = [w.encode() for w in words]
                yield batch(ASKED, [(r, block, put(put_sizes(map(len, raw[a:z]), z - a), b"".join(raw[a:z]))) for r, (a, z) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if z > a])

    return run


def put_sizes(sizes, n: int) -> bytes:
    """Counts in as few bytes as hold the largest, which the first byte says."""
    x = np.fromiter(sizes, np.int64, n)
    t = next(t for t in (np.uint8, np.uint16, np.int32) if t is np.int32 or not n or x.max() <= np.iinfo(t).max)
    return bytes([np.dtype(t).itemsize]) + x.astype(t).tobytes()


def get_sizes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: np.int32}[raw[0]], offset=1).astype(np.int32)


def tell(path: str):
    def run(t: pa.Table) -> pa.Table:
        v = vocabulary(path)
        known: dict[bytes, list[int]] = {}
        rows = []
        for part, block, blob in zip(*(t.column(c).to_pylist() for c in ("part", "block", "blob")), strict=True):
            sizes, content = get(blob)
            found = []
            for w in split_contents(get_sizes(sizes), content):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = v.encode_word(w.decode())
                found.append(ids)
            rows.append((block, part, put(put_sizes(map(len, found), len(found)), np.array([i for ids in found for i in ids], v.id_type))))
        return pa.Table.from_batches([batch(TOLD, rows)])

    return run


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """doc_id and ids, the ids of the text's tokens in order, a row for each row of docs. decoded: with text as decode_documents() adds it, by the same Python worker, where a task has two if the frames are chained."""
    blocks = pack(docs, id_col, text_col, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(8, -(-total // (24 << 20)))
    asked = blocks.mapInArrow(trimmed(ask(vocabulary_path, parts)), "part int, block long, blob binary")
    told = asked.groupBy("part").applyInArrow(trimmed(tell(vocabulary_path)), "block long, part int, blob binary")

    def run(batches):
        v = vocabulary(vocabulary_path)
        for rb in batches:
            for ids, lens, body, said in zip(*(rb.column(c).to_pylist() for c in ("ids", "lens", "body", "said")), strict=True):
                codes, n_words, _, _, place = distinct_words(v, unpack(ids, lens, body)[1], parts)
                answers = [get(x["blob"]) for x in sorted(said or (), key=lambda x: x["part"])]
                size = np.concatenate([np.zeros(0, np.int32), *(get_sizes(a[0]) for a in answers)])
                tokens = np.concatenate([np.zeros(0, v.id_type), *(np.frombuffer(a[1], v.id_type) for a in answers)])
                start = np.cumsum(size, dtype=np.int64) - size
                bounds = np.concatenate([[0], np.cumsum(n_words)])
                for a in range(0, len(n_words), 256):
                    upto = bounds[a : a + 257]
                    at = place[codes[upto[0] : upto[-1]]]
                    n = size[at].astype(np.int64)
                    ends = np.concatenate([[0], np.cumsum(n)])
                    out = tokens[np.repeat(start[at] - ends[:-1], n) + np.arange(ends[-1])]
                    offsets = ends[upto - upto[0]].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([ids_column(np.frombuffer(ids, np.int64)[a : a + 256]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.astype(np.int32)))], names=["doc_id", "ids"])

    if decoded:
        decode = decoding(docs.sparkSession, vocabulary_path)
        return with_replies(blocks, told).mapInArrow(trimmed(lambda batches: decode(run(batches))), "doc_id long, ids array<int>, text string")
    return with_replies(blocks, told).mapInArrow(trimmed(run), "doc_id long, ids array<int>")


def decoding(spark: SparkSession, vocabulary_path: str):
    """What decode_documents() does with batches of doc_id and ids."""
    pieces = spark.sparkContext.broadcast(vocabulary(vocabulary_path).pieces)

    def run(batches):
        table = pieces.value
        keys, values = table.column("id").combine_chunks(), table.column("piece").combine_chunks()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                rb = whole.slice(at, 256)
                ids = rb.column(1)
                flat = ids.flatten()
                found = pc.fill_null(values.take(pc.index_in(flat, value_set=keys)), b"")
                offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]).astype(np.int32)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), found), b"")
                texts = [t.decode("utf-8", "replace") for t in joined.to_pylist()]
                yield pa.RecordBatch.from_arrays([rb.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return run


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Adds text, decoded from ids; bytes that are no UTF-8 become U+FFFD. encoded: doc_id, ids.

    A hash join of ids with pieces; the pieces of a row keep its order and are put together.
    An id that the vocabulary does not have, and a null, give no text.
    """
    run = decoding(encoded.sparkSession, vocabulary_path)
    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), "doc_id long, ids array<int>, text string")
