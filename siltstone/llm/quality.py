"""A quality classifier over embeddings of words and of their pieces.

Each word and each run of 3 or 4 characters of a word between its bounds (a space stands
for each) is hashed to a learned vector; a word that repeats the one before adds a piece of
its own, and so does the end of the text. Their average over the whole text goes through a
softmax. Vectors and output are trained by stochastic gradient descent, a text at a time.

As the output is linear in the average, scoring looks up one number for each piece: the
difference that its vector makes. The table of these numbers has a fixed size and is
broadcast. Training takes at most about `max_train` labelled rows, chosen by a hash of the
id; everything else covers all rows.

Results for odd input: a null or empty text has the end of the text as its only piece; a
null id stays null and is not held out, and its labels are not used; of several rows
with one id one text is trained on, of several labels the largest; repeated rows each get
a result; an empty table gives no rows; without labels of both classes every score is the
share of label 1, or 0. Text is read in stretches of 512 KB that end at white space; a word
as long as that is cut there, and a repeat across stretches is not seen. Columns
besides id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._repeats import get, put
from siltstone.llm._scratch import chunks, ids_column, small_batches, trimmed

U = np.uint64
THRESHOLD = 0.3
MAX_TRAIN = 4_000
BITS, SIZE = 15, 16
GRAMS = (3, 4)
EPOCHS, RATE, SEED = 12, 0.5, 13
STRETCH = 1 << 19
AGAIN, END = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
_WHITE = b" \t\n\v\f\r"


def stretches(text: bytes) -> list[bytes]:
    """The text cut after STRETCH bytes at most, at white space if there is any."""
    out, a = [], 0
    while len(text) - a > STRETCH:
        z = max(text.rfind(w, a, a + STRETCH) for w in (_WHITE[i : i + 1] for i in range(len(_WHITE))))
        if z <= a:
            z = a + STRETCH
            while text[z] & 0xC0 == 0x80:  # not within a character
                z -= 1
        out.append(text[a:z])
        a = z
    return [*out, text[a:]]


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every piece but the end of each text, repeats included."""
    text = [t.decode("utf-8", "replace") for t in texts]
    c = np.frombuffer((" " + " ".join(text) + " ").encode("utf-32-le", "replace"), np.uint32)
    row = np.repeat(np.arange(len(text), dtype=np.int32), np.fromiter((len(t) + 1 for t in text), np.int64, len(text)))
    row = np.append(row, np.int32(max(len(text) - 1, 0)))  # each text with the space before it, and the last space
    white = (c == 32) | ((c >= 9) & (c <= 13))
    keep = ~white
    keep[1:] |= ~white[:-1]
    keep[0] = True
    c, row, white = np.where(white, np.uint32(32), c)[keep], row[keep], white[keep]
    symbols = H.mix(c.astype(U) + U(0x9E37))
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    at, to = edge[::2], edge[1::2]
    words = H.of_spans(H.running(symbols), at, to)
    rows, hashes = [row[at]], [words]
    again = np.flatnonzero((words[1:] == words[:-1]) & (row[at[1:]] == row[at[:-1]])) + 1
    rows.append(row[at[again]])
    hashes.append(np.full(len(again), AGAIN, U))
    spaces = np.concatenate([[0], np.cumsum(white)])
    for n in GRAMS:
        grams = H.of_grams(symbols, n)
        i = np.flatnonzero(spaces[n - 1 : n - 1 + len(grams)] == spaces[1 : 1 + len(grams)])  # no space inside
        rows.append(row[i + white[i]])
        hashes.append(grams[i] ^ U(n * 0x9E3779B1))
    return np.concatenate(rows), np.concatenate(hashes)


def totals(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the sum of the table's numbers over its pieces, and how many it has; the end included."""
    total = np.full(len(texts), table[int(END >> U(64 - BITS))])
    count = np.ones(len(texts))
    owner, held, size = [], [], 0

    def flush() -> None:
        if held:
            row, h = pieces(held)
            row = np.array(owner)[row]
            total[:] += np.bincount(row, table[h >> U(64 - BITS)], len(texts))
            count[:] += np.bincount(row, minlength=len(texts))

    for i, t in enumerate(texts):
        for s in stretches(t):
            if held and size + len(s) > STRETCH:
                flush()
                owner, held, size = [], [], 0
            owner.append(i)
            held.append(s)
            size += len(s)
    flush()
    return total, count


def shares(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the places of its pieces in the table, once each, and the share of pieces that are there."""
    out = []
    for t in texts:
        n = np.zeros(1 << BITS, np.int64)
        n[int(END >> U(64 - BITS))] = 1
        for s in stretches(t):
            n += np.bincount(pieces([s])[1] >> U(64 - BITS), minlength=1 << BITS)
        at = np.flatnonzero(n)
        out.append((at.astype(np.uint16), (n[at] / n.sum()).astype(np.float32)))
    return out


@dataclass
class Model:
    """table: what each piece adds to the log odds, before the average; bias: added to it."""

    table: np.ndarray
    bias: float = 0.0

    def score(self, texts: list[bytes]) -> np.ndarray:
        total, count = totals(texts, self.table)
        return 1 / (1 + np.exp(-np.clip(total / count + self.bias, -40, 40)))


def constant_model(share: float) -> Model:
    rate = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.zeros(1 << BITS), float(np.log(rate / (1 - rate))))


def descend(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Vectors of pieces and the output layer by stochastic gradient descent, a text a step, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (1 << BITS, SIZE)).astype(np.float32)
    out = np.zeros((2, SIZE), np.float32)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            at, share = examples[i]
            own = vectors[at]
            mean = share @ own
            z = out @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            step = rate * (1 - done / steps)
            back = p @ out
            out -= step * np.outer(p, mean)
            vectors[at] = own - (step * share)[:, None] * back
            done += 1
    return Model((vectors @ (out[1] - out[0])).astype(np.float64))


def held_out(id_col: Column | str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """A model from at most about max_train rows with a label that are not held out."""
    usable = labels.select(F.col(label_id).cast("long").alias("_i"), F.col(label_col).cast("int").alias("_y")).where(F.col("_i").isNotNull() & F.col("_y").isin(0, 1)).where(~held_out("_i"))
    one = usable.groupBy("_i").agg(F.max("_y").alias("_y"))
    n = one.count()
    if not n:
        return constant_model(0.0)
    scale = 1 << 30
    chosen = one.where(F.pmod(F.xxhash64("_i"), F.lit(scale)) < int(scale * min(1.0, max_train / n)))
    text = docs.select(F.col(id_col).cast("long").alias("_d"), F.col(text_col).cast("string").alias("_t"))
    # at most about max_train pairs of numbers, and one text of each
    rows = text.join(F.broadcast(chosen), text["_d"] == chosen["_i"]).groupBy("_i", "_y").agg(F.min(F.coalesce("_t", F.lit(""))).alias("_t"))

    def encoded(batches):
        for rb in batches:
            for a in range(rb.num_rows):
                (at, share), = shares([rb.column(2)[a].as_buffer().to_pybytes()])
                yield pa.RecordBatch.from_arrays([rb.column(0).slice(a, 1), rb.column(1).slice(a, 1), pa.array([put(at, share)], pa.binary())], names=["i", "y", "blob"])

    small_batches(docs.sparkSession)
    parts = rows.select("_i", "_y", F.col("_t").cast("binary")).mapInArrow(trimmed(encoded), "i long, y int, blob binary").toArrow().sort_by("i")
    y = parts.column("y").to_numpy()
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return constant_model(share)
    examples = [(np.frombuffer(a, np.uint16), np.frombuffer(b, np.float32)) for a, b in (get(x.as_py()) for x in parts.column("blob"))]
    return descend(examples, y)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score for each row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for ids, texts in chunks(batches, STRETCH):
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(shared.value.score(texts))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    scored = score_documents(docs, train(docs, labels, max_train=max_train))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
