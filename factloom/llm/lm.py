"""Language-model scores of whole documents by a gated recurrent model with a class-factored softmax.

Corpus counts cover all training rows and stay in a table; every task holds only the most frequent words (``hot``). The model
sees each token as a frequent word, as a band of words of about one frequency, or as a rare word; within a band and among
the rare words a word has its share of the counts, and those of the rare words come by a join. One further event of the
rare class stands for all words that training has not seen, as in the base score. Training reads all training rows once,
in rounds: every task trains a copy of the model on its own rows by truncated backpropagation, and the copies' means,
weighted by tokens, go into the next round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import gru, words
from factloom.llm.common import ship, trim, written

#: words whose counts every task holds and bytes of such a word; head words of the softmax, the end included; bands of two powers of two
HOT, HOT_BYTES, HEAD, BANDS = 1 << 17, 64, 512, 12
TAILS = BANDS + 1
RARE, END = HEAD + BANDS, 0
#: what a rare word's count is lowered by in favour of unseen words
DISCOUNT = 0.5
#: rounds of training by the sixteenths of the training rows that each takes
ROUNDS = ((0, 1), (1, 4), (4, 16))


def word_counts(t: DataFrame) -> DataFrame:
    """(word, n) over the column ``text``."""

    def count(batches):
        for b in batches:
            for i, j in words.slices(b.column(0)):
                codes, distinct = words.coded(words.words(b.column(0).slice(i, j - i), words.BETWEEN_BLANKS)[0])
                yield pa.record_batch([distinct, pa.array(np.bincount(codes, minlength=len(distinct)).astype(np.int64))], ["word", "n"])
            trim()

    return t.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What tasks need to know of the counts: the hot words (count 2 or more, the most frequent that fit), and sums.

    ``token``, ``within`` (log10 of a word's share of its class) and ``base`` (log10 by the base model) go with ``hot``.
    """

    def __init__(self, counts: DataFrame, ends: int, hot: int = HOT):
        levels = {r["level"]: (r["v"], r["n"]) for r in counts.groupBy(F.expr("int(log2(n))").alias("level")).agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()}
        self.ends, self.total, self.distinct = ends, sum(n for _, n in levels.values()) + ends, sum(v for v, _ in levels.values()) + (ends > 0)
        least = 1
        while sum(v for level, (v, _) in levels.items() if level >= least) > hot:
            least += 1
        got = counts.filter(F.expr("int(log2(n))") >= least).filter(F.octet_length("word") <= HOT_BYTES).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
        self.hot, n = got.column("word").combine_chunks().cast(pa.string()), got.column("n").to_numpy()
        band = np.minimum(BANDS - 1, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) // 2)
        at = np.arange(1, len(n) + 1)  # place 0 is the end
        self.token = np.where(at < HEAD, at, HEAD + band)
        mass = np.bincount(self.token, n, RARE + 1)
        mass[END] = ends
        self.within = np.where(at < HEAD, 0.0, np.log10(np.maximum(n, 1) / np.maximum(mass[self.token], 1)))
        self.rare_total = self.total - int(mass.sum())
        self.rare_distinct = self.distinct - len(n) - (ends > 0)
        mass[RARE] = self.rare_total
        self.base_total = self.total + 0.5 * (self.distinct + 1)
        self.base = np.log10((n + 0.5) / self.base_total)
        head = np.where(np.arange(HEAD) <= len(n), np.log(mass[:HEAD] + 0.5), -1e4)
        classes = np.concatenate([mass[:HEAD].reshape(-1, gru.CLASS).sum(1), mass[HEAD:]])
        there = np.concatenate([np.arange(HEAD // gru.CLASS) * gru.CLASS <= len(n), np.isin(np.arange(HEAD, RARE), self.token), [True]])
        self.log_class = np.where(there, np.log(classes + 0.5) - np.log(classes.sum() + 0.5 * there.sum()), -1e4)
        own = np.where(head.reshape(-1, gru.CLASS).max(1) > -1e4, head.reshape(-1, gru.CLASS).max(1), 0)
        self.log_word = (head.reshape(-1, gru.CLASS) - own[:, None]).ravel()

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """(tokens, bounds, words, place of each word's spelling in ``hot`` or -1): each text's words, then an end."""
        w, bounds, _ = words.words(texts, words.BETWEEN_BLANKS)
        codes, distinct = words.coded(w)
        at = pc.index_in(distinct, value_set=self.hot).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        token = np.where(at >= 0, np.append(self.token, RARE)[at], RARE)[codes]
        n = len(bounds) - 1
        out = np.full(len(w) + n, END, np.int64)
        out[np.arange(len(w)) + np.repeat(np.arange(n), np.diff(bounds))] = token
        return out, bounds + np.arange(n + 1), w, at[codes]

    def rare_within(self, n: Column) -> Column:
        """log10 of a rare word's share by its count; 0 or null is the event of an unseen word."""
        unseen = DISCOUNT * (self.rare_distinct + 1)
        mass = self.rare_total + DISCOUNT
        return F.log10(F.when(n > 0, n - DISCOUNT).otherwise(F.lit(unseen)) / F.lit(float(mass)))


def _packed(p: dict) -> bytes:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32).tobytes()


def _unpacked(x: bytes, like: dict) -> dict:
    flat, out, at = np.frombuffer(x, np.float32), {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _mean(batches):
    """The copies of a partition as one: their mean weighted by tokens, and their tokens and losses."""
    total, n, loss = None, 0, 0.0
    for b in batches:
        for x, k, l in zip(b.column("model"), b.column("n").to_pylist(), b.column("loss").to_pylist(), strict=True):
            x = np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) * k
            total, n, loss = x if total is None else total + x, n + k, loss + l
    if n:
        yield pa.record_batch([pa.array([(total / n).astype(np.float32).tobytes()]), pa.array([n], pa.int64()), pa.array([loss])], ["model", "n", "loss"])


def fit(train: DataFrame, vocabulary: Vocabulary, rounds: tuple = ROUNDS, seed: int = 1) -> tuple[dict, list[float]]:
    """(parameters, mean loss a token of each round) from the column ``text``: each row is learned from in one round, once.

    Rows that repeat are learned from as often as they occur. The driver gets up to 64 models a round (1 MB each).
    """
    sc = train.sparkSession.sparkContext
    p = gru.initial(HEAD, TAILS, vocabulary.log_word, vocabulary.log_class, seed)
    state = {**p, **{f"{k}_squares": np.full_like(v, 1e-8) for k, v in p.items()}}
    known, losses = sc.broadcast(vocabulary), []
    for low, high in rounds:
        sent = sc.broadcast(_packed(state))

        def learn(batches, sent=sent):
            from pyspark import TaskContext

            own = _unpacked(sent.value, state)
            p, squares, n, loss = {k: own[k] for k in own if not k.endswith("_squares")}, {k[:-8]: own[k] for k in own if k.endswith("_squares")}, 0, 0.0
            for b in batches:
                for i, j in words.slices(b.column(0)):
                    tokens, bounds, *_ = known.value.tokens(b.column(0).slice(i, j - i))
                    loss += gru.train(p, squares, tokens, bounds, HEAD, END)
                    n += len(tokens)
                trim()
            if n:
                model = _packed({**p, **{f"{k}_squares": v for k, v in squares.items()}})
                yield pa.record_batch([pa.array([TaskContext.get().partitionId() % 64], pa.int32()), pa.array([model], pa.binary()), pa.array([n], pa.int64()), pa.array([loss])], ["salt", "model", "n", "loss"])

        part = train.filter(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(16)).between(low, high - 1)).select("text")
        copies = part.mapInArrow(learn, "salt int, model binary, n long, loss double").repartition("salt").drop("salt").mapInArrow(_mean, "model binary, n long, loss double").collect()
        if copies:
            n = sum(r["n"] for r in copies)
            mean = sum(np.frombuffer(bytes(r["model"]), np.float32).astype(np.float64) * r["n"] for r in copies) / n
            state = _unpacked(mean.astype(np.float32).tobytes(), state)
            losses.append(sum(r["loss"] for r in copies) / n)
        sent.unpersist()
    return {k: v for k, v in state.items() if not k.endswith("_squares")}, losses


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, rounds: tuple = ROUNDS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the whole text's probability).

    Learns from the rows for which ``held_out`` is false. Tokens are the words between blanks and one end of text; a null or
    empty text is the end alone. Rows that repeat, or have no id, or share one, are scored each by its own text. Without
    training rows every token is the unseen event, with base score 0. An empty table gives none. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    train = t.filter("not held_out")
    counts = written(word_counts(train), "lm-counts")
    vocabulary = Vocabulary(counts, train.count(), hot)
    p, _ = fit(train, vocabulary, rounds)
    known, model = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(p)

    def score(batches):
        from pyspark import TaskContext

        key, v = TaskContext.get().partitionId() << 40, known.value
        end_base = float(np.log10((v.ends + 0.5) / v.base_total))
        for b in batches:
            for i, j in words.slices(b.column("text"), 1 << 25):
                own = b.slice(i, j - i)
                tokens, bounds, w, at = v.tokens(own.column("text"))
                n = j - i
                lp = gru.score(model.value, tokens, bounds, HEAD, END) / np.log(10)
                text = np.repeat(np.arange(n), np.diff(bounds) - 1)
                hot = at >= 0
                lp += np.bincount(text[hot], v.within[at[hot]], n)
                base = np.bincount(text[hot], v.base[at[hot]], n) + end_base
                seen = np.bincount(text[hot], minlength=n) + (v.ends > 0)
                rest = np.flatnonzero(~hot)
                ends = np.searchsorted(text[rest], np.arange(n + 1)).astype(np.int32)
                yield pa.record_batch([
                    pa.array(key + np.arange(n)), own.column("id"), own.column("held_out"), pa.array(np.diff(bounds)), pa.array(seen.astype(np.int64)), pa.array(base), pa.array(lp),
                    pa.ListArray.from_arrays(pa.array(ends), w.take(pa.array(rest)))], ["key", "id", "held_out", "n_tokens", "hot_known", "hot_base", "hot_score", "rare"])
                key += n
            trim()

    kind = t.schema["id"].dataType.simpleString()
    rows = written(t.mapInArrow(score, f"key long, id {kind}, held_out boolean, n_tokens long, hot_known long, hot_base double, hot_score double, rare array<string>"), "lm-rows")
    n = F.coalesce("n", F.lit(0))
    rare = rows.select("key", F.explode("rare").alias("word")).join(counts, "word", "left").groupBy("key").agg(
        F.count_if(n > 0).alias("rare_known"), F.sum(F.log10((n + 0.5) / F.lit(float(vocabulary.base_total)))).alias("rare_base"), F.sum(vocabulary.rare_within(n)).alias("rare_score"))
    found = rows.drop("rare").join(rare, "key", "left")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return found.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", add("hot_known", "rare_known").alias("n_known"), F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        add("hot_base", "rare_base").alias("base_score"), add("hot_score", "rare_score").alias("score"))
