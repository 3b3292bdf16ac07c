"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over words and beginnings of words that are there or not. Of
each labelled sentence that names a group of people, copies with the term swapped for
others of its language are made, and the square of the change of score is penalised,
so that naming a group says nothing either way.

Only words and word beginnings with a clear tie to the label in the training rows get
a weight. Training takes at most `max_train` labelled rows, chosen by a hash of the
id; everything else covers all rows.

Results for odd input: a null or empty text scores as one without any known word; a
null id stays null and is not held out; a label of a null id is not used; repeated
rows each get a result; an empty table gives no rows; without labels of both classes
every score is the share of label 1, or 0. Columns besides id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._repeats import get, put
from siltstone.llm._scratch import chunks, ids_column, persist, small_batches, trimmed
from siltstone.llm.decontamination import filter_rows

U = np.uint64
THRESHOLD = 0.3
MAX_TRAIN = 12_000
STEMS = (4, 5, 6)  # bytes of a word's beginning
#: Terms for groups of people, by language.
IDENTITY_TERMS = {
    "en": ["women", "men", "muslims", "christians", "jews", "hindus", "atheists", "immigrants", "refugees", "gays", "lesbians", "blacks", "whites", "asians", "latinos", "elderly", "disabled"],
    "de": ["frauen", "männer", "muslime", "christen", "juden", "hindus", "atheisten", "einwanderer", "flüchtlinge", "schwule", "lesben", "schwarze", "weiße", "asiaten", "alte", "behinderte"],
    "fr": ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "hindous", "athées", "immigrés", "réfugiés", "gays", "lesbiennes", "noirs", "blancs", "asiatiques", "vieux", "handicapés"],
    "es": ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "hindúes", "ateos", "inmigrantes", "refugiados", "gais", "lesbianas", "negros", "blancos", "asiáticos", "ancianos", "discapacitados"],
}
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word and each beginning of a word, repeats included."""
    buf = b" \n ".join([t.translate(_LETTERS) for t in texts])
    arr = np.frombuffer(buf, np.uint8)
    at, to = H.word_spans(arr)
    ends = np.cumsum(np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts)))
    row = np.searchsorted(ends, at, "right")
    c = H.running(H.byte_symbols(arr))
    rows, hashes = [row], [H.of_spans(c, at, to)]
    for n in STEMS:
        i = np.flatnonzero(to - at >= n)
        rows.append(row[i])
        hashes.append(H.of_spans(c, at[i], at[i] + n) ^ U(n * 0x9E3779B1))
    return np.concatenate(rows), np.concatenate(hashes)


@dataclass
class Model:
    """hashes: of the words with a weight, sorted; seen: which of their leading bits occur at all."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    seen: np.ndarray

    def logits(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        if len(self.hashes):
            row, h = features(texts)
            i = np.flatnonzero(self.seen[h >> U(44)])
            row, h = row[i], h[i]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            i = np.flatnonzero(self.hashes[at] == h)
            pair = np.unique(row[i] * len(self.hashes) + at[i])
            out += np.bincount(pair // len(self.hashes), self.weights[pair % len(self.hashes)], len(texts))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -40, 40)))


def counterfactuals(texts: list[bytes], others: int = 3) -> tuple[list[bytes], list[bytes]]:
    """Sentences that name a group, each beside copies with the term swapped."""
    swap: dict[bytes, list[bytes]] = {}
    for terms in IDENTITY_TERMS.values():
        raw = [t.encode() for t in terms]
        for i, t in enumerate(raw):
            swap.setdefault(t, [raw[(i + 1 + 5 * j) % len(raw)] for j in range(others)])
    given, changed = [], []
    for t in texts:
        clean = t.translate(_LETTERS)
        for term in {w for w in clean.split() if w in swap}:
            for sentence in t.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).replace(b"!", b".").replace(b"?", b".").replace(b"\n", b".").split(b"."):
                words = sentence.translate(_LETTERS).split()
                if term in words:
                    for new in swap[term]:
                        given.append(b" ".join(words))
                        changed.append(b" ".join([new if w == term else w for w in words]))
    return given, changed


def feature_counts(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each feature with the number of texts that have it, and of those of label 1."""
    row, h = features(texts)
    order = np.lexsort((row, h))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[new], h[new]
    found, at = np.unique(h, return_inverse=True)
    return found, np.bincount(at, minlength=len(found)), np.bincount(at, labels[row], len(found)).astype(np.int64)


def encode(texts: list[bytes], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and index of each known feature of each text, once each."""
    row, h = features(texts) if texts else (np.empty(0, np.int64), np.empty(0, U))
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    i = np.flatnonzero(vocabulary[at] == h)
    pair = np.unique(row[i] * len(vocabulary) + at[i])
    return pair // len(vocabulary), pair % len(vocabulary)


def is_clear(total, hits, share: float):
    """A clear tie to the label: at least five texts, a share of label 1 that is off by four standard errors and a factor of three. Numbers, arrays or columns."""
    off = (hits - total * share) * (hits - total * share) > 16 * share * (1 - share) * total
    return (total >= 5) & off & ((hits > total * (3 * share)) | (hits < total * (share / 3)))


def solve(labels: np.ndarray, row: np.ndarray, code: np.ndarray, size: int, swaps: tuple[int, np.ndarray, np.ndarray, np.ndarray], penalty: float, ridge: float, steps: int, weight: float) -> tuple[np.ndarray, float]:
    """Weights and bias. swaps: number of pairs, and pair, feature and sign of what a swap changes."""
    n, share = len(labels), labels.mean()
    n_swaps, swap_row, swap_code, swap_sign = swaps
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[code], n), -40, 40)))
        off = (p - labels) * np.where(labels > 0, weight, 1.0) / n
        g = np.bincount(code, off[row], size) + ridge * w / n
        if n_swaps:
            change = np.bincount(swap_row, w[swap_code] * swap_sign, n_swaps)
            g += 2 * penalty / n_swaps * np.bincount(swap_code, change[swap_row] * swap_sign, size)
        g = np.append(g, off.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w -= step[:-1]
        b -= step[-1]
    return w, float(b)


def make_model(vocabulary: np.ndarray, weights: np.ndarray, bias: float) -> Model:
    seen = np.zeros(1 << 20, bool)
    seen[vocabulary >> U(44)] = True
    return Model(vocabulary, weights, bias, seen)


def constant_model(share: float) -> Model:
    rate = min(max(share, 1e-9), 1 - 1e-9)
    return make_model(np.empty(0, U), np.empty(0), float(np.log(rate / (1 - rate))))


def encode_swaps(texts: list[bytes], vocabulary: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    given, changed = counterfactuals(texts)
    a, b = encode(given, vocabulary), encode(changed, vocabulary)
    return len(given), np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([np.ones(len(a[0])), -np.ones(len(b[0]))])


PENALTY, RIDGE, STEPS, WEIGHT = 1.0, 0.02, 400, 2.0


def fit(texts: list[bytes], labels: np.ndarray, penalty: float = PENALTY, ridge: float = RIDGE, steps: int = STEPS, weight: float = WEIGHT) -> Model:
    """Fit on texts and their labels (0 or 1) in memory; a row of label 1 counts `weight` times."""
    share = float(labels.mean()) if len(labels) else 0.0
    if not 0 < share < 1:
        return constant_model(share)
    found, total, hits = feature_counts(texts, labels)
    vocabulary = found[is_clear(total, hits, share)]
    if not len(vocabulary):
        return constant_model(share)
    row, code = encode(texts, vocabulary)
    return make_model(vocabulary, *solve(labels, row, code, len(vocabulary), encode_swaps(texts, vocabulary), penalty, ridge, steps, weight))


def held_out(id_col: Column | str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """A model from at most about max_train rows with a label that are not held out."""
    usable = labels.select(F.col(label_id).cast("long").alias("_i"), F.col(label_col).cast("int").alias("_y")).where(F.col("_i").isNotNull() & F.col("_y").isin(0, 1)).where(~held_out("_i"))
    one = usable.groupBy("_i").agg(F.max("_y").alias("_y"))
    n = one.count()
    if not n:
        return fit([], np.zeros(0))
    scale = 1 << 30
    chosen = one.where(F.pmod(F.xxhash64("_i"), F.lit(scale)) < int(scale * min(1.0, max_train / n)))
    # at most about max_train pairs of numbers: small by construction
    text = docs.select(F.col(id_col).cast("long").alias("_d"), F.col(text_col).cast("string").alias("_t"))
    rows = persist(text.join(F.broadcast(chosen), text["_d"] == chosen["_i"]).select("_y", "_t"), "training")
    n, hits = rows.agg(F.count("*"), F.sum("_y")).first()
    share = (hits or 0) / n if n else 0.0
    if not 0 < share < 1:
        return constant_model(share)

    def count(batches):
        for y, texts in chunks(batches, 1 << 19):
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in feature_counts(texts, y.astype(np.float64))], names=["h", "total", "hits"])

    counted = rows.mapInArrow(trimmed(count), "h long, total long, hits long").groupBy("h").agg(F.sum("total").alias("total"), F.sum("hits").alias("hits"))
    clear = counted.where(is_clear(F.col("total"), F.col("hits"), share)).select("h").toArrow()
    if not clear.num_rows:
        return constant_model(share)
    vocabulary = np.sort(clear.column("h").to_numpy().view(U))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encoded(batches):
        for y, texts in chunks(batches, 1 << 19):
            row, code = encode(texts, shared.value)
            n_swaps, swap_row, swap_code, sign = encode_swaps(texts, shared.value)
            blob = put(y.astype(np.float64), row, code, swap_row, swap_code, sign)
            yield pa.RecordBatch.from_arrays([pa.array([n_swaps], pa.int64()), pa.array([blob], pa.binary())], names=["n_swaps", "blob"])

    labels_, row, code, swap_row, swap_code, sign = ([] for _ in range(6))
    n = n_swaps = 0
    # known features of at most about max_train texts: a few numbers each
    parts = rows.mapInArrow(trimmed(encoded), "n_swaps long, blob binary").collect()
    for part in sorted(parts, key=lambda r: r["blob"]):
        y, r, c, sr, sc, sg = (np.frombuffer(x, t) for x, t in zip(get(part["blob"]), (np.float64, np.int64, np.int64, np.int64, np.int64, np.float64), strict=True))
        labels_.append(y)
        row.append(r + n)
        code.append(c)
        swap_row.append(sr + n_swaps)
        swap_code.append(sc)
        sign.append(sg)
        n, n_swaps = n + len(y), n_swaps + part["n_swaps"]
    join = np.concatenate
    return make_model(vocabulary, *solve(join(labels_), join(row), join(code), len(vocabulary), (n_swaps, join(swap_row), join(swap_code), join(sign)), PENALTY, RIDGE, STEPS, WEIGHT))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score for each row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for ids, texts in chunks(batches, 1 << 19):
            yield pa.RecordBatch.from_arrays([ids_column(ids), pa.array(shared.value.score(texts))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs."""
    scored = score_documents(docs, train(docs, labels, max_train=max_train))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, text_col=text_col, max_train=max_train))
    return filter_rows(docs, text_col, lambda texts: shared.value.score(texts) < threshold)
