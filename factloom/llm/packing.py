"""Packing: order-preserving dynamic programming over window cuts, with monotone-queue transitions.

Documents stay in ascending id order. Cuts may fall at document ends, after a sentence's last token, or (dearer) in
a sentence longer than a window. The cost of a sequence is its padding, its end's penalty and a fixed opening cost; the best cost at a
cut is a sliding-window minimum of (cost + position) over the cuts up to ``window`` before it, kept in a monotone
queue, and lengths that need no padding (powers of two) are transitions of their own.
"""

from __future__ import annotations

import zlib
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import ship, tidy, trim
from factloom.llm.token_file import in_order
from factloom.llm.tokens import KEPT, encoder, groups

WINDOW, SENTENCE, HARD, OPENING = 1024, 2, 12, 24
#: ids that are planned together; a plan ends with a document, so a longer document is planned alone
PLAN = 1 << 20
#: bytes of text that are encoded together
TEXT = 1 << 20
_ENDS: dict[str, np.ndarray] = {}


def sentence_ends(path: str) -> np.ndarray:
    """Which ids end a sentence or a line."""
    if path not in _ENDS:
        from tokenizers import Tokenizer

        vocab = Tokenizer.from_file(path).get_vocab()
        table = np.zeros(max(vocab.values()) + 1, bool)
        table[[i for t, i in vocab.items() if t[-1:] in (".", "!", "?", "Ċ")]] = True
        _ENDS[path] = table
    return _ENDS[path]


def padding(n: int, window: int) -> int:
    return 0 if n & (n - 1) == 0 else window - n


def plan(total: int, doc_ends: np.ndarray, sentences: np.ndarray, window: int = WINDOW, sentence: int = SENTENCE, hard: int = HARD, opening: int = OPENING) -> np.ndarray:
    """Cut positions 0 = c0 < c1 < ... = total with the least cost, sequences of at most ``window``."""
    base = np.unique(np.concatenate([[0], doc_ends, sentences]))
    gap = np.diff(base)
    far = np.flatnonzero(gap > window)  # a sentence longer than a window: full windows from its start on
    extra = [np.arange(base[i] + window, base[i + 1], window) for i in far]
    pos = np.unique(np.concatenate([base, *extra]))
    pos = pos[pos <= total]
    cost = np.full(len(pos), float(hard))
    cost[np.searchsorted(pos, base)] = sentence
    cost[np.searchsorted(pos, doc_ends)] = 0
    cost += opening
    # transitions of lengths that need no padding (only those over an eighth of a window pay for their opening)
    short: dict[int, list[int]] = {}
    for m in range(window.bit_length()):
        if window // 8 <= 1 << m < window:
            at = np.searchsorted(pos, pos - (1 << m))
            hit = np.flatnonzero(pos[np.minimum(at, len(pos) - 1)] == pos - (1 << m))
            for i, j in zip(hit.tolist(), at[hit].tolist(), strict=True):
                short.setdefault(i, []).append(j)
    p, pen, n = pos.tolist(), cost.tolist(), len(pos)
    # best[i]: least cost of all up to cut i; key[i] = best[i] + p[i] is what the queues order by. Queue 1 holds the cuts
    # up to a window back, queue 2 those up to a window further: a full window, cut hard, and then the rest.
    best, key, back = [0.0] * n, [0.0] * n, [0] * n
    one, two, h1, h2, entered, none = [0], [], 0, 0, 0, ()
    extra = hard + opening + window
    for i in range(1, n):
        x = p[i]
        low = x - window
        while p[one[h1]] < low:
            h1 += 1
        j = one[h1]
        c = key[j] - low
        while p[entered] < low:
            v = key[entered]
            while len(two) > h2 and key[two[-1]] >= v:
                two.pop()
            two.append(entered)
            entered += 1
        while len(two) > h2 and p[two[h2]] < low - window:
            h2 += 1
        if len(two) > h2 and key[two[h2]] - low + extra < c:
            j = ~two[h2]
            c = key[two[h2]] - low + extra
        for k in short.get(i, none):
            if best[k] <= c:
                j, c = k, best[k]
        best[i] = c = c + pen[i]
        back[i] = j
        key[i] = v = c + x
        while len(one) > h1 and key[one[-1]] >= v:
            one.pop()
        one.append(i)
    cuts, i = [p[-1]], n - 1
    while i:
        i = back[i]
        if i < 0:
            i = ~i
            cuts.append(p[i] + window)
        cuts.append(p[i])
    return np.array(cuts[::-1])


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0, window: int = WINDOW, sentence: int = SENTENCE, hard: int = HARD, kept: int = KEPT) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id lies in one piece. A null text is one end id; null ids come first. Partitions are ranges of ids, planned
    on their own (``kept``: distinct pieces that a worker's encoder remembers); sequence ids are the partition's number times 2^40 plus a running number. Empty tables give none.
    """
    ship(docs.sparkSession)
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def rows(doc_ids, null, ids, bounds, ends, base):
        cuts = plan(int(bounds[-1]), bounds[1:], np.flatnonzero(ends[np.minimum(ids, len(ends) - 1)]) + 1, window, sentence, hard)
        at = np.unique(np.concatenate([bounds, cuts]))
        a, b = at[:-1], at[1:]
        doc, seq = np.searchsorted(bounds, a, "right") - 1, np.searchsorted(cuts, a, "right") - 1
        crc = [zlib.crc32(ids[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        cols = [pa.array(doc_ids[doc], mask=null[doc]), a - bounds[doc], b - a, pa.array(crc, pa.int64()), np.diff(bounds)[doc], seq + base, a - cuts[seq]]
        return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in cols], names), len(cuts) - 1

    def work(batches):
        enc, ends, used = encoder(tokenizer, kept), sentence_ends(tokenizer), TaskContext.get().partitionId() << 40
        held, parts, sizes, n = [], [], [], 0
        def flush():
            null = np.array([x is None for x in held])
            return rows(np.array([x or 0 for x in held], np.int64), null, np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), ends, used)
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for i, j in groups(texts, TEXT):
                ids, bounds = enc.encode(texts.slice(i, j - i), end)
                held += names[i:j]
                parts.append(ids)
                sizes.append(np.diff(bounds))
                n += len(ids)
                if n >= PLAN:
                    out, k = flush()
                    used += k
                    held, parts, sizes, n = [], [], [], 0
                    yield out
                    trim()
        if held:
            yield flush()[0]

    return in_order(docs, id_col, text_col).mapInArrow(tidy(work), ", ".join(f"`{x}` long" for x in names))
