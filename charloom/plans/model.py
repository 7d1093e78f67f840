"""The character n-gram model as a set of DataFrames.

A model is counts, not probabilities: ``context_chars`` (trimmed), ``unigram``
and ``continuation`` plus a few scalars.  Discount and smoothing are applied in
the prediction fold, so retuning them never rewrites a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import NEWLINES, nfc, scoring_suffix
from charloom.operators import counts, predict as pred_ops, scoring
from charloom.operators.scoring import BaseStats
from charloom.operators.trim import trim

# A guess table of more rows (about 130 bytes each) is not broadcast.
BROADCAST_CONTEXTS = 500_000

# The built-in padding characters, in order.
BUILTIN_DEFAULT_CHARS = [" ", ".", ",", "。", "،", "।", "，", "・", "-"]


@dataclass(frozen=True)
class ModelParams:
    # The published default configuration.
    ngram_order: int = 6
    laplace_alpha: float = 1.0
    max_chars_per_context: int = 64
    min_context_count: int = 3
    max_contexts: int = 1_000_000
    kn_discount: float = 0.75


def _persist(df: DataFrame, enabled: bool) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK) if enabled else df


def merge_defaults(frequent: list[str], current: list[str]) -> list[str]:
    """Ordered distinct union, first occurrence wins (dict keys keep their order)."""
    return list(dict.fromkeys(frequent) | dict.fromkeys(current))


def frequent_chars(unigram: DataFrame, k: int) -> list[str]:
    """The ``k`` most frequent characters, ties by first appearance, newlines
    removed.  Bounded by ``k``, so it is collected."""
    if k <= 0:
        return []
    rows = unigram.orderBy(F.col("cnt").desc(), F.col("first_seen").asc()).limit(k).collect()
    return [r["ch"] for r in rows if r["ch"] not in NEWLINES]


@dataclass
class CharModel:
    params: ModelParams
    context_chars: DataFrame   # context, ctx_len, ch, cnt, first_seen, ctx_rank, char_rank
    unigram: DataFrame         # ch, cnt, first_seen
    continuation: DataFrame    # ch, cont, first_seen
    total_bigram_types: int
    default_chars: list[str] = field(default_factory=lambda: list(BUILTIN_DEFAULT_CHARS))
    _stats: BaseStats | None = None
    _levels: DataFrame | None = None
    _prefix: dict = field(default_factory=dict)
    _unseen: dict = field(default_factory=dict)
    _tables: dict = field(default_factory=dict)

    # ------------------------------------------------------------------ fit
    @classmethod
    def fit(cls, corpus: DataFrame, params: ModelParams = ModelParams(), cache: bool = True) -> "CharModel":
        """Count (A1-A4), trim (P4), refresh defaults.

        ``corpus`` needs ``line_id`` (the line order) and NFC ``text``."""
        raw = count_corpus(corpus, params.ngram_order, cache)
        return cls.from_counts(raw, params, cache)

    @classmethod
    def from_counts(cls, raw: "RawCounts", params: ModelParams, cache: bool = True) -> "CharModel":
        trimmed = trim(raw.pairs, params.min_context_count, params.max_contexts,
                       params.max_chars_per_context)
        trimmed = _persist(trimmed, cache)
        defaults = list(BUILTIN_DEFAULT_CHARS)
        if raw.n_unigram_types > 0:
            defaults = merge_defaults(frequent_chars(raw.unigram, params.max_chars_per_context), defaults)
        return cls(params, trimmed, raw.unigram, raw.continuation, raw.total_bigram_types, defaults)

    # ------------------------------------------------------------ derived
    def base_stats(self) -> BaseStats:
        if self._stats is None:
            if self.total_bigram_types > 0:
                v = self.continuation.count()
                self._stats = BaseStats(True, int(self.total_bigram_types), max(1, v))
            else:
                row = self.unigram.agg(F.count(F.lit(1)).alias("v"), F.sum("cnt").alias("n")).first()
                self._stats = BaseStats(False, int(row["n"] or 0), max(1, int(row["v"])))
        return self._stats

    def base_counts(self) -> DataFrame:
        return scoring.base_counts(self.unigram, self.continuation, self.base_stats())

    def base(self, alpha: float | None = None) -> DataFrame:
        """M1/M2 table ``(ch, b, first_seen)``."""
        a = self.params.laplace_alpha if alpha is None else alpha
        return scoring.base_table(self.base_counts(), a, self.base_stats())

    def levels(self) -> DataFrame:
        """Packed per-context counts, kept hash-partitioned and sorted by context:
        every later join on ``context`` shuffles only the suffix side."""
        if self._levels is None:
            lv = scoring.levels(self.context_chars, self.base_counts(), vocab_size=self.base_stats().vb)
            spark = lv.sparkSession
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            lv = lv.repartition(parts, "context").sortWithinPartitions("context")
            self._levels = lv.persist(StorageLevel.MEMORY_AND_DISK)
        return self._levels

    def ranking_prefix(self, k: int, alpha: float | None = None) -> list[tuple[str, int]]:
        a = self.params.laplace_alpha if alpha is None else alpha
        key = (k, a)
        if key not in self._prefix:
            per_level = max(self.params.max_chars_per_context, 0)
            length = k + max(self.params.ngram_order - 1, 0) * per_level
            self._prefix[key] = scoring.base_ranking_prefix(self.base_counts(), a, self.base_stats(), length)
        return self._prefix[key]

    def prepare(self, k: int = 3, guess_table: bool = False) -> "CharModel":
        """Build the scoring tables once (the reference does this when it loads a
        model): base scalars, the persisted levels table and the ranking prefix.
        ``guess_table`` also scores every stored context now, which pays when many more
        inputs than contexts, or many batches of inputs, are to be predicted."""
        self.base_stats()
        self.levels().count()
        self.unseen_guesses(k)
        if guess_table:
            self.guess_table(k)
        return self

    # ------------------------------------------------------------- predict
    def suffix_links(self) -> DataFrame:
        """``(context, link, lens)``: the next shorter stored context of every stored
        context ('' if there is none) and the lengths of all its stored suffixes."""
        own = self.levels().select(F.col("context").alias("sfx"))
        found = pred_ops.stored_suffixes(own, self.levels())
        shorter = F.slice("lens", 1, F.size("lens") - 1)
        link = F.when(F.size("lens") > 1, F.right("sfx", F.array_max(shorter))).otherwise("")
        return found.select(F.col("sfx").alias("context"), link.alias("link"), "lens")

    def _scored(self, lv: DataFrame, k: int) -> DataFrame:
        """``(sfx, guesses)`` from rows holding matched levels."""
        p, stats = self.params, self.base_stats()
        a = float(p.laplace_alpha)
        return pred_ops.score_rows(
            lv, F.lit(float(p.kn_discount)), F.lit(a), F.lit(float(stats.denominator(a))), k,
            pred_ops.lit_ranking(self.ranking_prefix(k)),
            pred_ops.lit_str_array(self.default_chars)).select("sfx", "guesses")

    def unseen_guesses(self, k: int = 3) -> list[str]:
        """The guesses for an input without any stored context."""
        if k not in self._unseen:
            levels = self.levels()
            none = levels.sparkSession.range(1).select(F.lit("").alias("sfx"))
            empty = F.array().cast("array<struct<L:int,total:bigint,n_types:bigint,ents:array<struct<ch:string,cnt:bigint,bc:bigint>>>>")
            self._unseen[k] = self._scored(none.withColumn("lv", empty), k).first()["guesses"]
        return self._unseen[k]

    def guess_table(self, k: int = 3) -> DataFrame:
        """``(context, ctx_len, guesses)`` of every stored context, scored once and kept."""
        if k not in self._tables:
            chains = self.suffix_links().select(F.col("context").alias("ctx"), "lens")
            scored = self._scored(pred_ops.chain_levels(chains, self.levels()), k)
            table = scored.select(F.col("sfx").alias("context"), F.length("sfx").alias("ctx_len"), "guesses")
            table = table.persist(StorageLevel.MEMORY_AND_DISK)
            self._tables[k] = (table, table.count())
        return self._tables[k][0]

    def _guesses_by_context(self, x: DataFrame, k: int) -> DataFrame:
        """Adds ``_found`` to rows with ``sfx``: scores the longest contexts that occur."""
        # Read by two branches and not persisted: a call leaves nothing behind in the
        # executors, however many calls or micro-batches a session makes.
        sfx = x.select("sfx").where(F.col("sfx").isNotNull()).distinct()
        longest = pred_ops.longest_context(pred_ops.stored_suffixes(sfx, self.levels()))
        chains = longest.groupBy("ctx").agg(F.first("lens").alias("lens"))  # equal for equal contexts
        scored = self._scored(pred_ops.chain_levels(chains, self.levels()), k)
        scored = scored.select(F.col("sfx").alias("ctx"), F.col("guesses").alias("_found"))
        return x.join(longest.select("sfx", "ctx").join(scored, "ctx").drop("ctx"), "sfx", "left")

    def predict(self, inputs: DataFrame, k: int = 3, text_col: str = "text",
                id_cols: tuple[str, ...] = ("qid",), normalize: bool = True) -> DataFrame:
        """P5: ``(id_cols..., pred, guesses)`` for every input row (blank rows included)."""
        p = self.params
        t = nfc(text_col) if normalize else F.col(text_col)
        x = inputs.select(*id_cols, F.col(text_col).isNull().alias("_null"), t.alias("_t"))
        x = x.withColumn("sfx", F.when(~F.col("_null"), scoring_suffix("_t", p.ngram_order))).drop("_t")
        table, contexts = self._tables.get(k, (None, 0))
        if table is None:
            out = self._guesses_by_context(x, k)
        elif contexts <= BROADCAST_CONTEXTS:
            out = pred_ops.look_up_broadcast(x, table, max(p.ngram_order - 1, 0))
        else:
            out = pred_ops.look_up_shuffled(x, table)
        fallback = pred_ops.lit_str_array(pred_ops.fallback_guesses(self.default_chars, k))
        unseen = pred_ops.lit_str_array(self.unseen_guesses(k))
        guesses = F.when(F.col("_null"), fallback).otherwise(F.coalesce("_found", unseen))
        out = out.select(*id_cols, guesses.alias("guesses"))
        return out.select(*id_cols, F.array_join("guesses", "").alias("pred"), "guesses")

    # ------------------------------------------------- second trims
    def prune(self, min_context_count: int = 5, max_contexts: int = 300_000,
              max_chars_per_context: int = 48, cache: bool = True) -> "CharModel":
        """Re-trim the stored counts; base, unigram and defaults untouched."""
        cc = trim(self.context_chars, min_context_count, max_contexts, max_chars_per_context, ranked=True)
        params = replace(self.params, min_context_count=min_context_count, max_contexts=max_contexts,
                         max_chars_per_context=max_chars_per_context)
        return CharModel(params, _persist(cc, cache), self.unigram, self.continuation,
                         self.total_bigram_types, list(self.default_chars), self._stats)

    def retrim(self, min_context_count: int, max_contexts: int, cache: bool = True) -> "CharModel":
        """Re-trim with new minimum and cap, same characters per context; the
        defaults are refreshed (which leaves them unchanged)."""
        cc = trim(self.context_chars, min_context_count, max_contexts,
                  self.params.max_chars_per_context, ranked=True)
        params = replace(self.params, min_context_count=min_context_count, max_contexts=max_contexts)
        return CharModel(params, _persist(cc, cache), self.unigram, self.continuation,
                         self.total_bigram_types, list(self.default_chars), self._stats)

    def with_scoring(self, kn_discount: float | None = None, laplace_alpha: float | None = None) -> "CharModel":
        params = replace(self.params,
                         kn_discount=self.params.kn_discount if kn_discount is None else kn_discount,
                         laplace_alpha=self.params.laplace_alpha if laplace_alpha is None else laplace_alpha)
        return CharModel(params, self.context_chars, self.unigram, self.continuation,
                         self.total_bigram_types, list(self.default_chars), self._stats, self._levels)

    def release(self) -> None:
        """Unpersist this model's cached tables (long-lived sessions)."""
        for df in (self.context_chars, self._levels, *(t for t, _ in self._tables.values())):
            if df is not None:
                df.unpersist(blocking=False)
        self._levels = None
        self._tables.clear()

    # -------------------------------------------------------------- stats
    def stats(self) -> DataFrame:
        """Contexts stored, stored (context, char) entries, unigram vocabulary,
        continuation vocabulary, bigram types."""
        cc = self.context_chars.agg(F.countDistinct("context").alias("contexts_stored"),
                                    F.count(F.lit(1)).alias("entries_stored"))
        uni = self.unigram.agg(F.count(F.lit(1)).alias("unigram_vocab_size"),
                               F.sum("cnt").alias("unigram_total"))
        cont = self.continuation.agg(F.count(F.lit(1)).alias("continuation_vocab_size"))
        key = F.lit(0).alias("_k")
        out = cc.select(key, "*").join(uni.select(key, "*"), "_k").join(cont.select(key, "*"), "_k")
        return out.drop("_k").withColumn("total_bigram_types", F.lit(int(self.total_bigram_types)).cast("long"))


@dataclass
class RawCounts:
    """Untrimmed counts of a corpus at one order (or the largest order of a grid)."""
    pairs: DataFrame        # context, ctx_len, ch, cnt, first_seen
    unigram: DataFrame
    continuation: DataFrame
    total_bigram_types: int
    n_unigram_types: int

    def release(self) -> None:
        """Unpersist the counts, once the models made of them are done."""
        for df in (self.pairs, self.unigram, self.continuation):
            df.unpersist(blocking=False)


def count_corpus(corpus: DataFrame, order: int, cache: bool = True) -> RawCounts:
    """A1-A4 in one pass over the corpus."""
    # Bigrams need windows of two characters even when order < 2.
    wins = _persist(counts.window_counts(corpus.select("line_id", "text"), max(order, 2)), cache)
    all_pairs = counts.context_char_counts(wins)
    if order < 2:
        all_pairs = _persist(all_pairs, cache)
    pairs = all_pairs.where(F.col("ctx_len") <= order - 1)
    pairs = _persist(pairs, cache) if order >= 2 else pairs
    uni = _persist(counts.unigram_counts(wins), cache)
    cont = _persist(counts.continuation_counts(pairs if order >= 2 else all_pairs), cache)
    agg = cont.agg(F.sum("cont").alias("t")).first()   # materialises pairs and cont
    n_uni = uni.count()                                  # materialises uni
    if cache and order >= 2:
        # Everything downstream reads pairs / uni / cont; the per-window table
        # (the largest intermediate) is no longer needed.
        wins.unpersist(blocking=False)
    return RawCounts(pairs, uni, cont, int(agg["t"] or 0), int(n_uni))
