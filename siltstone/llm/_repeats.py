"""Finding windows of a fixed length that occur more than once in a corpus.

What `substring_dedup` and `suffix_array` share: where suffixes start, which of
them can repeat at all, and how they travel. Which of them do repeat is decided
by the order of the suffixes, and each of the two brings its own.

1. Every window of W symbols (words or bytes) holds an anchor, a k-gram chosen by
   its content alone, so equal windows have equal anchors at equal places.
2. Hashes of anchors, once per block, are dealt out by range; a block is told
   which of its anchors occur in another block. That only prunes.
3. The context of each remaining anchor, W symbols to the right of its start and
   W - k to its left, is kept once per block with what the rule needs, and sent
   to the group of its prefix. A prefix that is too frequent for one task is made
   longer, see Plan. There the suffixes are sorted, exactly and by their symbols;
   windows are equal where suffixes to the right of the anchor and reversed
   prefixes to its left share enough symbols.
4. Each block gets back a bit per context and window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import _hashing as H
from siltstone.llm._scratch import compress, expand, pack, persist, shuffle_width, trimmed, unpack, with_replies

U = np.uint64
KEY_BITS = 48  # of an anchor's hash that travel for pruning
GROUP_BYTES = 24 << 20  # of contexts that a task sorts at once
SLICE = 1 << 19  # symbols whose hashes are held at once, or one document
HIST = (1 << 10, 1 << 14, 1 << 18)  # counters of prefixes of 1, 2 and 3 words


@dataclass(frozen=True)
class Rule:
    """words: symbols are words, else bytes. first: only later documents lose a window, else every occurrence does."""

    words: bool
    window: int
    k: int
    first: bool

    @property
    def slack(self) -> int:
        return self.window - self.k


@dataclass
class Block:
    """buf: bytes of the whole block; at, to: byte span of each word (None where bytes are the symbols); doc: of each symbol; start: first symbol of each document and the end."""

    ids: np.ndarray
    texts: list[bytes]
    buf: bytes
    at: np.ndarray | None
    to: np.ndarray | None
    doc: np.ndarray
    start: np.ndarray

    def symbols(self, a: int, z: int) -> np.ndarray:
        """Of the symbols from a to z."""
        if self.at is None:
            return H.byte_symbols(np.frombuffer(self.buf, np.uint8, z - a, a))
        lo, hi = int(self.at[a]), int(self.to[z - 1])
        return H.word_symbols(np.frombuffer(self.buf, np.uint8, hi - lo, lo), self.at[a:z] - lo, self.to[a:z] - lo)

    def span(self, a: np.ndarray, z: np.ndarray) -> tuple[list[int], list[int]]:
        """Bytes from symbol a up to symbol z."""
        if self.at is None:
            return a.tolist(), z.tolist()
        return self.at[a].tolist(), self.to[z - 1].tolist()


def read_block(rule: Rule, ids: np.ndarray, texts: list[bytes]) -> Block:
    if rule.words:
        texts = [b" ".join(t.split()) for t in texts]
        buf = b"\n".join(texts) + b"\n"
        at, to = H.word_spans(np.frombuffer(buf, np.uint8))
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        doc = np.searchsorted(ends, at, "right").astype(np.int32)
        return Block(ids, texts, buf, at, to, doc, np.searchsorted(doc, np.arange(len(ids) + 1)))
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return Block(ids, texts, b"".join(texts), None, None, np.repeat(np.arange(len(ids), dtype=np.int32), lens), np.concatenate([[0], np.cumsum(lens)]))


def anchors(rule: Rule, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors and the keys of their hashes. Some documents at a time: no window crosses two."""
    places, keys = [np.empty(0, np.int64)], [np.empty(0, U)]
    first = 0
    while first < len(b.ids):
        last = max(int(np.searchsorted(b.start, b.start[first] + SLICE, "right")) - 1, first + 1)
        a, z = int(b.start[first]), int(b.start[last])
        first = last
        n = z - a - rule.window + 1
        if n <= 0:
            continue
        grams = H.of_grams(b.symbols(a, z), rule.k) | U(1)
        valid = np.zeros(len(grams), bool)
        valid[:n] = b.doc[a : a + n] == b.doc[a + rule.window - 1 : z]
        p = H.winnow(grams, valid, rule.slack + 1)
        places.append(p + a)
        # winnowing prefers small hashes; mixed once more, keys are even over the ranges they are dealt by
        keys.append(H.mix(grams[p]) >> U(64 - KEY_BITS))
    return np.concatenate(places), np.concatenate(keys)


def put_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, a plane for each of their bytes."""
    d = np.diff(keys, prepend=U(0)).astype("<u8")
    return compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T).tobytes())


def get_keys(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(blob), np.uint8).reshape(KEY_BITS // 8, -1)
    d = np.zeros((planes.shape[1], 8), np.uint8)
    d[:, : KEY_BITS // 8] = planes.T
    return np.cumsum(d.view("<u8").ravel(), dtype=U)


def batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema, strict=True)], names=[n for n, _ in schema])


KEYS = [("part", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())]


def send_keys(rule: Rule, bits: int) -> Callable:
    def run(batches):
        for rb in batches:
            for block, ids, lens, body in zip(*(rb.column(c).to_pylist() for c in ("block", "ids", "lens", "body")), strict=True):
                _, keys = anchors(rule, read_block(rule, *unpack(ids, lens, body)))
                keys = np.unique(keys)
                cut = np.searchsorted(keys, np.arange((1 << bits) + 1).astype(U) << U(KEY_BITS - bits))
                yield batch(KEYS, [(r, block, put_keys(keys[a:z])) for r, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if z > a])

    return run


def find_shared(t: pa.Table) -> pa.Table:
    """Of the keys of one range: to each block those that another block has too."""
    blocks = t.column("block").to_pylist()
    lists = [get_keys(x) for x in t.column("blob").to_pylist()]
    keys = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    cut = np.searchsorted(owner, np.arange(len(lists) + 1))
    rows = [(block, put_keys(k)) for i, block in enumerate(blocks) if len(k := lists[i][shared[cut[i] : cut[i + 1]]])]
    return pa.Table.from_batches([batch(KEYS[1:], rows)])


@dataclass
class Contexts:
    """position, which: an anchor and its context, for each remaining anchor. The rest is for each distinct context."""

    position: np.ndarray
    which: np.ndarray
    content: list[bytes]
    left: np.ndarray
    right: np.ndarray
    extra: np.ndarray


def contexts(rule: Rule, b: Block, shared: np.ndarray) -> Contexts:
    p, keys = anchors(rule, b)
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    live = (count > 1)[inverse]
    if len(shared):
        i = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        live |= shared[i] == keys
    p = p[live]
    left = np.minimum(p - b.start[b.doc[p]], rule.slack)
    right = np.minimum(b.start[b.doc[p] + 1] - p, rule.window)
    seen: dict[tuple[int, bytes], int] = {}
    which = np.empty(len(p), np.int32)
    kept: list[int] = []
    for j, (a, z, n) in enumerate(zip(*b.span(p - left, p + right), left.tolist(), strict=True)):
        i = seen.setdefault((n, b.buf[a:z]), len(kept))
        which[j] = i
        if i == len(kept):
            kept.append(j)
    kept_a = np.array(kept, np.int64)
    if rule.first:
        extra = np.full(len(kept), 2**63 - 1, np.int64)
        np.minimum.at(extra, which, b.ids[b.doc[p]])
    else:
        extra = np.minimum(np.bincount(which, minlength=len(kept)), 2).astype(np.int64)
    return Contexts(p, which, [c for _, c in seen], left[kept_a], right[kept_a], extra)


def put(*parts: np.ndarray | bytes) -> bytes:
    raw = [x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes() for x in parts]
    return compress(np.array([len(raw), *map(len, raw)], np.int64).tobytes() + b"".join(raw))


def get(blob: bytes) -> list[bytes]:
    raw = expand(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8).tolist()
    out, at = [], 8 * (n + 1)
    for s in sizes:
        out.append(raw[at : at + s])
        at += s
    return out


def split_contents(lens: np.ndarray, content: bytes) -> list[bytes]:
    out, at = [], 0
    for n in lens.tolist():
        out.append(content[at : at + n])
        at += n
    return out


FOUND = [("kind", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())]
PER_CONTEXT = 24  # bytes of a context besides its content


def prefix_codes(rule: Rule, content: list[bytes], left: np.ndarray) -> np.ndarray:
    """A counter for the prefixes of 1, 2 and 3 words of each suffix; none for bytes."""
    out = np.zeros((len(content), 3), np.int64)
    for i, (c, n) in enumerate(zip(content, left.tolist(), strict=True) if rule.words else ()):
        w = c.split(b" ", n + 3)[n : n + 3]
        out[i] = [_code(b" ".join(w[: j + 1])) % m for j, m in enumerate(HIST)]
    return out


def _code(x: bytes, seed: int = 0) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(x, seed) >> 1


def part_of(rule: Rule, content: bytes, left: int, before: int, after: int) -> bytes:
    """Symbols of a context from `before` to the left of its anchor's start up to `after` to the right."""
    if rule.words:
        return b" ".join(content.split(b" ")[left - before : left + after])
    return content[left - before : left + after]


def send_contexts(rule: Rule) -> Callable:
    def run(batches):
        for rb in batches:
            for block, ids, lens, body, said in zip(*(rb.column(c).to_pylist() for c in ("block", "ids", "lens", "body", "said")), strict=True):
                b = read_block(rule, *unpack(ids, lens, body))
                shared = np.sort(np.concatenate([get_keys(x["blob"]) for x in said])) if said else np.empty(0, U)
                c = contexts(rule, b, shared)
                if not len(c.position):
                    continue
                n = len(c.content)
                sizes = np.fromiter(map(len, c.content), np.int32, n)
                weight = int(sizes.sum()) + PER_CONTEXT * n
                codes = prefix_codes(rule, c.content, c.left)
                rows = [
                    ("state", block, weight, put(c.position, c.which, c.left, c.right, c.extra)),
                    ("contexts", block, weight, put(sizes, c.left.astype(np.int32), c.right.astype(np.int32), c.extra, codes, b"".join(c.content))),
                ]
                if rule.words:
                    rows.append(("counts", block, weight, put(*(np.bincount(codes[:, j], sizes + PER_CONTEXT, m).astype(np.int64) for j, m in enumerate(HIST)))))
                yield batch(FOUND, rows)

    return run


def add_counts(t: pa.Table) -> pa.Table:
    total = [np.zeros(m, np.int64) for m in HIST]
    for blob in t.column("blob").to_pylist():
        for x, part in zip(total, get(blob), strict=True):
            x += np.frombuffer(part, np.int64)
    return pa.Table.from_batches([batch([("blob", pa.binary())], [(put(*total),)])])


def plan_prefixes(found: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """Prefixes of as many words as it takes for a group of at most GROUP_BYTES; -1 where three are not enough.

    The counts are of fixed size (HIST), whatever the corpus; they are added up in
    two steps, so that no task reads those of all blocks.
    """
    width = shuffle_width(found.sparkSession)
    counts = found.where("kind = 'counts'").select(F.pmod(F.hash("block"), F.lit(width)).alias("g"), "blob")
    parts = counts.groupBy("g").applyInArrow(trimmed(add_counts), "blob binary").withColumn("g", F.lit(0)).groupBy("g").applyInArrow(trimmed(add_counts), "blob binary").first()
    if parts is None:
        return lambda codes: codes[:, 0]
    one, two, three = (np.frombuffer(x, np.int64) for x in get(parts["blob"]))
    small1, small2, small3 = one <= GROUP_BYTES, two <= GROUP_BYTES, three <= GROUP_BYTES
    # rare prefixes share a group, filled up to the bound
    bin1, bin2, bin3 = (np.cumsum(np.where(small, n, 0)) // GROUP_BYTES for small, n in ((small1, one), (small2, two), (small3, three)))

    def of(codes: np.ndarray) -> np.ndarray:
        longest = np.where(small3[codes[:, 2]], (2 << 40) + bin3[codes[:, 2]], -1)
        return np.where(small1[codes[:, 0]], bin1[codes[:, 0]], np.where(small2[codes[:, 1]], (1 << 40) + bin2[codes[:, 1]], longest))

    return of


@dataclass
class Plan:
    """Which group a context goes to, and for which windows.

    prefix: groups of short prefixes (words); contexts it gives -1, all if it is None,
    go on by longer strings. A window that starts l symbols before the anchor, l from
    lo to hi, holds the lo symbols before the anchor and the W - hi from it on, so
    contexts that share such a window share that string: first the anchor itself, for
    all l. Strings in `hot` are too frequent for one group; their range of l is halved,
    which makes the string longer, until a group fits or the string is one window.
    Windows that are too frequent even so are settled by a sum over all blocks (best).
    """

    rule: Rule
    prefix: Callable | None
    groups: int
    hot: np.ndarray
    best: dict[int, int]

    def is_hot(self, code: int) -> bool:
        i = int(np.searchsorted(self.hot, code))
        return i < len(self.hot) and int(self.hot[i]) == code

    def place(self, content: bytes, left: int, right: int) -> list[tuple[int, int, int]]:
        """(code, lo, hi) of each group for one context."""
        w, out, todo = self.rule.window, [], [(0, self.rule.slack)]
        while todo:
            lo, hi = todo.pop()
            if left < lo or right < w - hi:
                continue  # none of its windows starts there
            code = _code(part_of(self.rule, content, left, lo, w - hi), (lo << 16) + hi + 1)
            if lo < hi and self.is_hot(code):
                mid = (lo + hi) // 2
                todo += [(lo, mid), (mid + 1, hi)]
            else:
                out.append((code, lo, hi))
        return out

    def left_over(self, codes: np.ndarray) -> list[int]:
        """Contexts that no short prefix places."""
        return (np.arange(len(codes)) if self.prefix is None else np.flatnonzero(self.prefix(codes) < 0)).tolist()


def open_contexts(blob: bytes) -> tuple:
    sizes, left, right, extra, codes, content = get(blob)
    sizes = np.frombuffer(sizes, np.int32)
    return split_contents(sizes, content), np.frombuffer(left, np.int32), np.frombuffer(right, np.int32), np.frombuffer(extra, np.int64), np.frombuffer(codes, np.int64).reshape(-1, 3)


def weigh(plan: Plan) -> Callable:
    """By code, whether it stands for one window, the bytes of its contexts, and what the rule needs of a window."""

    def run(batches):
        for rb in batches:
            for blob in rb.column("blob").to_pylist():
                content, left, right, extra, codes = open_contexts(blob)
                total: dict[int, list] = {}
                for i in plan.left_over(codes):
                    x = int(extra[i])
                    for code, lo, hi in plan.place(content[i], int(left[i]), int(right[i])):
                        have = total.setdefault(code, [lo == hi, 0, 2**63 - 1, 0])
                        have[1] += len(content[i]) + PER_CONTEXT
                        have[2] = min(have[2], x)
                        have[3] += 0 if plan.rule.first else x
                cols = list(zip(*total.values(), strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), *(pa.array(c, t) for c, t in zip(cols, (pa.bool_(), pa.int64(), pa.int64(), pa.int64()), strict=True))], names=["code", "single", "n", "least", "times"])

    return run


def make_plan(rule: Rule, found: DataFrame) -> Plan:
    """Strings are lengthened round by round, at most log2(W - k) + 1 times; each round only lists those above GROUP_BYTES, which are at most the bytes of all contexts over GROUP_BYTES."""
    sent = found.where("kind = 'contexts'")
    total = sent.agg(F.sum("n")).first()[0] or 0
    plan = Plan(rule, plan_prefixes(found) if rule.words else None, max(1, -(-2 * total // GROUP_BYTES)), np.empty(0, np.int64), {})
    while True:
        weights = sent.select("blob").mapInArrow(trimmed(weigh(plan)), "code long, single boolean, n long, least long, times long").groupBy("code", "single").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("times").alias("times"))
        more = weights.where(F.col("n") > GROUP_BYTES).collect()
        split = [r["code"] for r in more if not r["single"]]
        if not split:
            plan.best = {r["code"]: r["least" if rule.first else "times"] for r in more}
            return plan
        plan = Plan(rule, plan.prefix, plan.groups, np.sort(np.concatenate([plan.hot, np.array(split, np.int64)])), {})


SENT = [("dest", pa.int64()), ("block", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("blob", pa.binary())]


def pack_group(plan: Plan, lo: int, hi: int, rows: list[int], content: list[bytes], left: np.ndarray, right: np.ndarray, extra: np.ndarray) -> bytes:
    """What a group needs of some contexts: those that look alike from hi symbols before the anchor to W - lo after are sent once."""
    whole = lo == 0 and hi == plan.rule.slack
    seen: dict[tuple[int, bytes], int] = {}
    which, lefts, rights = np.empty(len(rows), np.int32), [], []
    for j, i in enumerate(rows):
        n, m, c = int(left[i]), int(right[i]), content[i]
        if not whole:
            cut_n, cut_m = min(n, hi), min(m, plan.rule.window - lo)
            c, n, m = part_of(plan.rule, c, n, cut_n, cut_m), cut_n, cut_m
        which[j] = seen.setdefault((n, c), len(lefts))
        if which[j] == len(lefts):
            lefts.append(n)
            rights.append(m)
    parts = [c for _, c in seen]
    return put(np.array(rows, np.int32), which, extra[rows], np.fromiter(map(len, parts), np.int32, len(parts)), np.array(lefts, np.int32), np.array(rights, np.int32), b"".join(parts))


SETTLED = -1


def _dest(lo: int, hi: int, group: int) -> int:
    """A group holds one range of windows."""
    return (1 << 61) + (lo << 48) + (hi << 36) + group


def deal(plan: Plan) -> Callable:
    def run(batches):
        for rb in batches:
            for block, blob in zip(rb.column("block").to_pylist(), rb.column("blob").to_pylist(), strict=True):
                content, left, right, extra, codes = open_contexts(blob)
                to: dict[tuple[int, int, int], list[int]] = {}
                settled: list[tuple[int, int]] = []
                if plan.prefix is not None:
                    for i, d in enumerate(plan.prefix(codes).tolist()):
                        if d >= 0:
                            to.setdefault((d, 0, plan.rule.slack), []).append(i)
                for i in plan.left_over(codes):
                    for code, lo, hi in plan.place(content[i], int(left[i]), int(right[i])):
                        if lo == hi and code in plan.best:
                            x = plan.best[code]
                            if (x < extra[i]) if plan.rule.first else (x >= 2):
                                settled.append((i, lo))
                        else:
                            to.setdefault((_dest(lo, hi, code % plan.groups), lo, hi), []).append(i)
                if plan.best and settled:
                    index, shift = np.array(settled, np.int64).T
                    packed = np.zeros((len(index), -(-(plan.rule.slack + 1) // 8)), np.uint8)
                    packed[np.arange(len(index)), shift >> 3] = 1 << (7 - (shift & 7))
                    own, at = np.unique(index, return_inverse=True)
                    bits = np.zeros((len(own), packed.shape[1]), np.uint8)
                    np.bitwise_or.at(bits, at, packed)
                    yield batch(SENT, [(SETTLED, block, 0, 0, put(own.astype(np.int32), bits))])
                rows = []
                for (d, lo, hi), mine in to.items():
                    rows.append((d, block, lo, hi, pack_group(plan, lo, hi, mine, content, left, right, extra)))
                    if len(rows) == 512:
                        yield batch(SENT, rows)
                        rows = []
                if rows:
                    yield batch(SENT, rows)

    return run


ANSWER = [("block", pa.int64()), ("blob", pa.binary())]


def judge(rule: Rule, classes: Callable) -> Callable:
    """classes(content, left, right, lo, hi) yields, for l from lo to hi, the rows whose window starting l symbols before the anchor lies in the document, and its class."""

    def run(t: pa.Table) -> pa.Table:
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        blocks, index, extra, which = [], [], [], []
        # equal contexts of several blocks are one from here on
        seen: dict[tuple[int, bytes], int] = {}
        left, right = [], []
        for block, blob in zip(t.column("block").to_pylist(), t.column("blob").to_pylist(), strict=True):
            i, own, ext, sizes, lft, rgt, content = get(blob)
            lft, rgt = np.frombuffer(lft, np.int32).tolist(), np.frombuffer(rgt, np.int32).tolist()
            number = np.empty(len(lft), np.int32)
            for j, x in enumerate(zip(lft, split_contents(np.frombuffer(sizes, np.int32), content), strict=True)):
                number[j] = seen.setdefault(x, len(left))
                if number[j] == len(left):
                    left.append(lft[j])
                    right.append(rgt[j])
            blocks.append(block)
            index.append(np.frombuffer(i, np.int32))
            extra.append(np.frombuffer(ext, np.int64))
            which.append(number[np.frombuffer(own, np.int32)])
        cut = np.concatenate([[0], np.cumsum([len(x) for x in index])])
        extra, which = np.concatenate(extra), np.concatenate(which)
        if rule.first:
            value = np.full(len(left), 2**63 - 1, np.int64)
            np.minimum.at(value, which, extra)
        else:
            value = np.bincount(which, weights=extra, minlength=len(left)).astype(np.int64)
        packed = np.zeros((len(which), -(-(rule.slack + 1) // 8)), np.uint8)
        for shift, (rows, cls) in enumerate(classes([c for _, c in seen], np.array(left, np.int32), np.array(right, np.int32), lo, hi), lo):
            if not len(rows):
                continue
            order = np.argsort(cls, kind="stable")
            head = np.flatnonzero(np.diff(cls[order], prepend=-1))
            got = (np.minimum if rule.first else np.add).reduceat(value[rows[order]], head)
            best = np.full(len(left), 2**63 - 1 if rule.first else 0, np.int64)
            best[rows[order]] = np.repeat(got, np.diff(head, append=len(order)))
            hit = best[which] < extra if rule.first else best[which] >= 2
            packed[:, shift >> 3] |= hit.astype(np.uint8) << np.uint8(7 - (shift & 7))
        rows = [(block, put(index[j], packed[cut[j] : cut[j + 1]])) for j, block in enumerate(blocks)]
        return pa.Table.from_batches([batch(ANSWER, rows)])

    return run


def starts_of(rule: Rule, b: Block, said: list[dict] | None) -> np.ndarray:
    """Marks the symbols at which a window starts that the rule takes out."""
    marks = np.zeros(len(b.doc), bool)
    state = [x["blob"] for x in said or () if x["kind"] == "state"]
    if not state:
        return marks
    position, which, _, _, extra = get(state[0])
    position, which, extra = np.frombuffer(position, np.int64), np.frombuffer(which, np.int32), np.frombuffer(extra, np.int64)
    width = -(-(rule.slack + 1) // 8)
    bits = np.zeros((len(extra), width), np.uint8)
    for x in said:
        if x["kind"] == "answer":
            i, packed = get(x["blob"])
            bits[np.frombuffer(i, np.int32)] |= np.frombuffer(packed, np.uint8).reshape(-1, width)
    p = position
    start = b.start[b.doc[p]]
    end = b.start[b.doc[p] + 1]
    later = b.ids[b.doc[p]] > extra[which] if rule.first else None
    for shift in range(rule.slack + 1):
        hit = (bits[which, shift >> 3] >> (7 - (shift & 7)) & 1).astype(bool)
        if later is not None:
            hit |= later
        s = p - shift
        ok = hit & (s >= start) & (s + rule.window <= end)
        marks[s[ok]] = True
    return marks


def covered(marks: np.ndarray, window: int) -> np.ndarray:
    """Symbols within a window that starts at a mark."""
    c = np.concatenate([[0], np.cumsum(marks)])
    i = np.arange(len(marks))
    return c[i + 1] > c[np.maximum(i + 1 - window, 0)]


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, rule: Rule, classes: Callable, finish: Callable, schema: str, block_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    blocks = pack(docs, id_col, text_col, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    density = (2 / (rule.slack + 2)) / (6 if rule.words else 1)
    bits = max(6, int(np.ceil(np.log2(max(1.0, total * density / 1.5e6)))))
    keys = blocks.mapInArrow(trimmed(send_keys(rule, bits)), "part int, block long, blob binary")
    shared = keys.groupBy("part").applyInArrow(trimmed(find_shared), "block long, blob binary")
    found = persist(with_replies(blocks, shared).mapInArrow(trimmed(send_contexts(rule)), "kind string, block long, n long, blob binary"), "contexts")
    plan = make_plan(rule, found)
    sent = found.where("kind = 'contexts'").select("block", "blob").mapInArrow(trimmed(deal(plan)), "dest long, block long, lo int, hi int, blob binary")
    answers = sent.where(F.col("dest") != SETTLED).groupBy("dest").applyInArrow(trimmed(judge(rule, classes)), "block long, blob binary")
    if plan.best:
        answers = answers.unionByName(sent.where(F.col("dest") == SETTLED).select("block", "blob"))
    said = found.where("kind = 'state'").select("block", "kind", "blob").unionByName(answers.withColumn("kind", F.lit("answer")))

    def run(batches):
        for rb in batches:
            for ids, lens, body, said in zip(*(rb.column(c).to_pylist() for c in ("ids", "lens", "body", "said")), strict=True):
                b = read_block(rule, *unpack(ids, lens, body))
                yield from finish(b, covered(starts_of(rule, b, said), rule.window))

    return with_replies(blocks, said).mapInArrow(trimmed(run), schema)
