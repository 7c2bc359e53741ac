"""Language identification by interpolated Kneser-Ney character models.

For each language a character n-gram model is estimated over the spelling of
words (with their beginning and end).  Discounted probabilities, back-off
weights and lower-order continuation probabilities of all languages share
sorted arrays of n-gram hashes with one column per language.  A text gets the
language of least cross-entropy per character.  Words are scored once per
worker, so a text costs a look-up for each word.

The models are fitted on a bounded sample: at most ``SAMPLE`` rows of each
language, those whose hashed id is smallest, and of these the first ones that
hold the language's share of ``SAMPLE_BYTES`` (one row at least).  Every
language that has a labelled row is learned.  A fifth of the sample calibrates:
how sharply differences of cross-entropy decide (``score``), and how large the
cross-entropy of accepted texts is (``rejected``).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import claim_worker, filter_slices, fold, map_slices

#: Rows of each language that are fitted on, at most; bytes of text of all languages together.
SAMPLE, SAMPLE_BYTES = 1000, 256 << 20
ORDER, DISCOUNT, CACHE_ENTRIES, CHARACTERS_AT_ONCE, LONG, UNDETERMINED = 4, 0.75, 200_000, 100_000, 64, "und"
#: Rejection: this many calibrated deviations above the mean cross-entropy and nearer to that of random letters, for texts of some length.
REJECT_DEVIATIONS, LEAST_CHARACTERS = 6.0, 40
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; numerals that are no decimal digits part words too."""
    out: list[str] = []
    for w in _WORD.findall(text.lower()):
        if w.isalpha():
            out.append(w)
        else:
            out += "".join(c if c.isalpha() else " " for c in w).split()
    return out


def _events(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each character or word end (event x order), of their contexts, and the event's word."""
    n = np.array([len(w) + 1 for w in words], np.int64)
    flat = np.frombuffer(("\x03".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(2)
    own = np.repeat(np.arange(len(words)), n)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    with np.errstate(over="ignore"):
        grams, contexts = np.empty((len(flat), ORDER), np.uint64), np.empty((len(flat), ORDER), np.uint64)
        context = np.zeros(len(flat), np.uint64)
        for k in range(ORDER):
            if k:
                before = np.ones(len(flat), np.uint64)
                before[k:] = np.where(place[k:] >= k, flat[:-k], np.uint64(1))
                context = (context ^ before * np.uint64(0x9E3779B97F4A7C15 + 2 * k)) * np.uint64(0xBF58476D1CE4E5B9)
                context ^= context >> np.uint64(29)
            contexts[:, k] = context + np.uint64(k)
            grams[:, k] = (contexts[:, k] ^ flat * np.uint64(0x94D049BB133111EB)) * np.uint64(0x9E3779B97F4A7C15)
            grams[:, k] ^= grams[:, k] >> np.uint64(31)
    return grams, contexts, own


class KneserNey:
    """One model per language over shared sorted hash arrays."""

    def __init__(self, counts: list[Counter]):
        """``counts``: for each language, how often each word occurs."""
        self.n = len(counts)
        words = sorted(set().union(*counts)) or [""]
        weight = np.array([[c.get(w, 0) for c in counts] for w in words], float).reshape(len(words), self.n)
        grams, contexts, own = _events(words)
        self.grams, self.contexts, self.prob, self.backoff = [], [], [], []
        for k in range(ORDER):
            keys, first, at = np.unique(grams[:, k], return_index=True, return_inverse=True)
            ctx_keys, ctx_at = np.unique(contexts[first, k], return_inverse=True)
            if k == ORDER - 1:
                count = np.stack([np.bincount(at, weight[own, j], len(keys)) for j in range(self.n)], 1)
            else:  # continuation: in how many longer n-grams it occurs
                longer, lfirst, lat = np.unique(grams[:, k + 1], return_index=True, return_inverse=True)
                seen = np.stack([np.bincount(lat, weight[own, j], len(longer)) for j in range(self.n)], 1) > 0
                count = np.stack([np.bincount(at[lfirst], seen[:, j], len(keys)) for j in range(self.n)], 1)
            total = np.stack([np.bincount(ctx_at, count[:, j], len(ctx_keys)) for j in range(self.n)], 1)
            kinds = np.stack([np.bincount(ctx_at, count[:, j] > 0, len(ctx_keys)) for j in range(self.n)], 1)
            self.grams.append(keys)
            self.prob.append(np.maximum(count - DISCOUNT, 0) / np.maximum(total[ctx_at], 1))
            self.contexts.append(ctx_keys)
            self.backoff.append(np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0))
        self.uniform = 1.0 / max(64, len(self.grams[0]) + 1)

    @staticmethod
    def _rows(table: np.ndarray, values: np.ndarray, keys: np.ndarray, default: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where((table[at] == keys)[:, None], values[at], default)

    def log2(self, words: list[str]) -> np.ndarray:
        """log2 of each word's probability (word x language), by a bounded number of characters at a time."""
        out, group, size = [], [], 0
        for w in words:
            if group and size + len(w) > CHARACTERS_AT_ONCE:
                out.append(self._log2(group))
                group, size = [], 0
            if len(w) <= CHARACTERS_AT_ONCE:
                group.append(w)
                size += len(w)
            else:
                out.append(self._log2_of_long(w))
        return np.concatenate([*out, self._log2(group)] if group or not out else out)

    def _log2_of_long(self, word: str) -> np.ndarray:
        """One word part by part; each part follows the characters that its first n-grams reach back to."""
        total = np.zeros((1, self.n))
        for at in range(0, len(word), CHARACTERS_AT_ONCE):
            back, end = min(at, ORDER - 1), at + CHARACTERS_AT_ONCE
            events = self._log2_of_events([word[at - back : end]])[0]
            total += events[back : None if end >= len(word) else -1].sum(axis=0)
        return total

    def _log2(self, words: list[str]) -> np.ndarray:
        logs, own = self._log2_of_events(words)
        return np.stack([np.bincount(own, logs[:, j], len(words)) for j in range(self.n)], 1)

    def _log2_of_events(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """log2 of the probability of each character and word end, and its word."""
        grams, contexts, own = _events(words)
        p = np.full((len(grams), self.n), self.uniform)
        for k in range(ORDER):
            p = self._rows(self.grams[k], self.prob[k], grams[:, k], 0.0) + self._rows(self.contexts[k], self.backoff[k], contexts[:, k], 1.0) * p
        return np.log2(p), own


class Identifier:
    """Models with calibration; one copy per worker caches words."""

    def __init__(self, languages: list[str], samples: list[list[str]]):
        """``samples``: texts of each language."""
        self.languages = languages
        fitted = [[t for i, t in enumerate(s) if i % 5 or len(s) < 5] for s in samples]
        self.model = KneserNey([Counter(w for t in s for w in words_of(t)) for s in fitted] or [Counter()])
        self.sharpness, self.mean, self.deviation = 1.0, np.full(len(languages), 4.0), np.full(len(languages), 4.0)
        tests = [(j, t) for j, s in enumerate(samples) for i, t in enumerate(s) if i % 5 == 0 or len(s) < 5]
        bits, n, _ = self.bits([t for _, t in tests])
        right = np.array([j for j, _ in tests], np.int64)
        full = n > 0
        bits, right = bits[full], right[full]
        if len(bits):
            # sharpness: the power of likelihood per character that makes the true languages likeliest
            best = max(2.0 ** np.arange(-2, 8), key=lambda s: self._likelihood(bits, right, s))
            self.sharpness = float(best)
            for j in range(len(languages)):
                if len(own := bits[right == j, j]):
                    self.mean[j], self.deviation[j] = own.mean(), max(own.std(), 0.1)
        self.memory: dict[str, int] = {}
        self.table = np.zeros((0, len(languages)))

    @staticmethod
    def _likelihood(bits: np.ndarray, right: np.ndarray, sharpness: float) -> float:
        z = -bits * sharpness
        return float((z[np.arange(len(z)), right] - np.logaddexp2.reduce(z, axis=1)).sum())

    def __getstate__(self):
        return self.__dict__ | {"memory": {}, "table": np.zeros((0, self.model.n))}

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Cross-entropy per character (text x language), characters, and whether a text has a letter."""
        parts = [words_of(t) for t in texts]
        memory = self.__dict__.get("memory", {})
        if len(memory) > CACHE_ENTRIES:
            memory.clear()
            self.table = np.zeros((0, self.model.n))
        # long words come last, so that they can be given up again
        new = sorted({w for p in parts for w in p} - memory.keys(), key=lambda w: len(w) > LONG)
        table, n_known = self.__dict__.get("table", np.zeros((0, self.model.n))), len(memory)
        if new:
            memory.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
            table = np.concatenate([table, self.model.log2(new)])
        size = np.array([sum(map(len, p)) + len(p) for p in parts], np.int64)
        sums = np.array([table[list(map(memory.__getitem__, p))].sum(axis=0) if p else np.zeros(self.model.n) for p in parts]).reshape(len(parts), self.model.n)
        letters = [bool(p) or any(c.isalpha() for c in t) for p, t in zip(parts, texts, strict=True)]
        n_long = sum(len(w) > LONG for w in new)
        for w in new[len(new) - n_long :]:
            del memory[w]
        if "table" in self.__dict__:
            self.table = table[: n_known + len(new) - n_long].copy() if n_long else table
        return -sums / np.maximum(size, 1)[:, None], size, letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """Language, score, bits per character and rejection of each text."""
        claim_worker("language_id")
        bits, size, letters = self.bits([t or "" for t in texts])
        out: list[tuple[str, float, float | None, bool]] = []
        best = bits.argmin(axis=1) if self.languages else np.zeros(len(texts), int)
        for t, row, j, n, any_letter in zip(texts, bits, best.tolist(), size.tolist(), letters, strict=True):
            if t is None or not any_letter or not self.languages:
                out.append((UNDETERMINED, 0.0, None, True))
                continue
            z = -row * self.sharpness
            score = float(2.0 ** (z[j] - np.logaddexp2.reduce(z)))
            random = -np.log2(self.model.uniform)
            far = row[j] > max(self.mean[j] + REJECT_DEVIATIONS * self.deviation[j], (self.mean[j] + random) / 2) and n >= LEAST_CHARACTERS
            out.append((self.languages[j], min(max(score, 0.0), 1.0), float(row[j]), bool(far)))
        return out


def fit(docs: DataFrame) -> Identifier:
    """Models from a bounded sample of the labelled rows of each language outside the held-out fold."""
    source = docs.filter((fold() != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in source.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return Identifier([], [])
    # a share of ids that leaves about twice the sample of each language, so that few rows are ranked
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    large = {k: int((1 << 30) * 2 * SAMPLE / n) for k, n in sizes.items() if n > 2 * SAMPLE}
    share = F.create_map(*[F.lit(x) for kv in large.items() for x in kv])[F.col("lang")] if large else F.lit(None)
    some = source.filter(share.isNull() | (draw <= share))
    order = Window.partitionBy("lang").orderBy(draw, "doc_id", "text")
    ranked = some.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= SAMPLE)
    held = ranked.withColumn("_bytes", F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)))
    bounded = held.filter(F.coalesce("_bytes", F.lit(0)) < SAMPLE_BYTES // len(sizes))
    rows = bounded.select("lang", "text").orderBy("lang", "_n").toArrow().to_pylist()
    languages = sorted(sizes)
    return Identifier(languages, [[r["text"] for r in rows if r["lang"] == x] for x in languages])


def identify(docs: DataFrame, fitted: Identifier | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits, rejected`` of each row.

    Learns from text and non-null ``lang`` of the rows outside the held-out
    fold (``crc32(doc_id as text) mod 3 = 1``); predictions see the text only.
    A null text, or one without a letter (``str.isalpha`` of a character), is ``und`` with score 0 and rejected.
    A text is rejected too where its cross-entropy is far above that of its
    language's sample.  Without any labelled row all texts are ``und``.  Of
    languages that are equally likely the alphabetically first is taken.  A text
    of any length is read whole.  Repeated rows are predicted each.  Other columns are ignored.  An empty
    table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fitted or fit(docs))  # bounded by the sample

    def run(batch: pa.RecordBatch) -> dict:
        found = sent.value.predict(batch.column(2).to_pylist())
        return {"doc_id": batch.column(0), "held_out": batch.column(1)} | {c: [f[i] for f in found] for i, c in enumerate(("lang_pred", "score", "bits", "rejected"))}

    schema = "doc_id long, held_out boolean, lang_pred string, score double, bits double, rejected boolean"
    return map_slices(docs.select("doc_id", (fold() == 1).alias("held_out"), "text"), run, schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected texts (null ones, ones without a letter, and ones unlike any language).

    One pass; repeated rows are judged each, the other columns travel along.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    return filter_slices(docs, lambda b: [not p[3] for p in sent.value.predict(b.column(b.schema.get_field_index("text")).to_pylist())])
