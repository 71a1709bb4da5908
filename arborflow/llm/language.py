"""Language identification by interpolated Kneser-Ney character models kept as sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import keep, mixed, ship, text_blocks

#: Longest context plus one: four characters, eight bits each, make one 32-bit word.
ORDER = 4
#: A language's 3- and 4-grams that make up less than this share of its order are scored by their shorter contexts, so a
#: language has at most 1 / MIN_SHARE of them in the model, whatever the corpus holds; none that occurs in every 500,000 goes.
#: Of 1- and 2-grams, at most 256 and 65,536, all are kept.
MIN_SHARE = 2e-6
#: Different 4-grams of a language that a counting task holds before it passes them on.
HELD_GRAMS = 1 << 20
#: Absolute discount of every order.
DISCOUNT = 0.75
#: Rejection: cross-entropy above a language's mean by so many standard deviations of the documents it is learnt from.
REJECT_SIGMAS = 8.0
#: Least deviation counted with: its texts may be few or alike, and mixed or noisy prose is still prose.
LEAST_DEVIATION = 0.2
#: Documents with fewer letters are never rejected for their cross-entropy: too little is known.
MIN_LETTERS = 30
UNDETERMINED = "und"

_codes: list[np.ndarray] = []


def _code_table() -> np.ndarray:
    """Code of each code point: 0 for what is no letter, own codes for lower-case Latin-1 letters, hashed ones beyond."""
    if not _codes:
        points = np.arange(0x110000, dtype=np.uint64)
        table = (64 + mixed(points) % np.uint64(192)).astype(np.uint8)
        for p in range(0x110000):
            if not chr(p).isalpha():
                table[p] = 0
        for k, p in enumerate([*range(0x61, 0x7B), *range(0xDF, 0x100)]):
            if table[p]:
                table[p] = 1 + k
        _codes.append(table)
    return _codes[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-grams, number of grams of each text, letters of each text).

    Texts are lower-cased; a run of other characters counts as one boundary. Each text starts and ends with boundaries.
    """
    joined = "".join(t + "\n\n\n" for t in texts).lower()
    if len(joined) != sum(map(len, texts)) + 3 * len(texts):  # lower-casing may lengthen a text
        texts = [t.lower() for t in texts]
        joined = "".join(t + "\n\n\n" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = _code_table()[points]
    text = np.repeat(np.arange(len(texts)), [len(t) + 3 for t in texts])[: len(code)]
    letter = code > 0
    some = letter.copy()
    some[1:] |= letter[:-1]  # a boundary is the first other character after a letter
    code, text = code[some], text[some]
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint8), code]).astype(np.uint32)
    n = len(code)
    gram = (padded[:n] << 24) | (padded[1 : n + 1] << 16) | (padded[2 : n + 2] << 8) | padded[3 : n + 3]
    # what reaches back into the text before is cut to boundaries
    first = np.flatnonzero(np.diff(text, prepend=-1))
    for back in range(ORDER - 1):
        at = first + back
        at = at[(at < n)]
        at = at[text[at] == text[first[: len(at)]]] if len(at) else at
        gram[at] &= np.uint32((1 << (8 * (back + 1))) - 1)
    count = np.bincount(text, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    letters = np.bincount(text[code > 0], minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    return gram, count, letters


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each language's 4-grams; what has gathered leaves when it is large."""
    held: dict[str, list] = {}

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        gram = np.concatenate([p[0] for p in parts])
        unique, at = np.unique(gram, return_inverse=True)
        return unique, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

    for frame in text_blocks(frames, "text"):
        for lang, rows in frame.groupby("lang"):
            gram, _, _ = grams(rows.text.tolist())
            parts = held.setdefault(lang, [])
            parts.append(np.unique(gram, return_counts=True))
            if len(parts) > 8:
                held[lang] = [merged(parts)]
                if len(held[lang][0][0]) > HELD_GRAMS:
                    unique, count = held.pop(lang)[0]
                    yield pd.DataFrame({"lang": lang, "gram": unique.astype(np.int64), "n": count})
    for lang, parts in held.items():
        unique, count = merged(parts)
        yield pd.DataFrame({"lang": lang, "gram": unique.astype(np.int64), "n": count})


@dataclass
class Model:
    """Natural-log probabilities of each order's known grams, interpolated to the bottom, for every language at once.

    grams[k] are the sorted k+1-grams; logs[k][i, lang] is log p(last | before); backoff[k][i, lang] is the log weight
    that a context of k+1 characters gives the shorter one; floor is what is left for characters never seen.
    """

    langs: list[str]
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float
    mean: np.ndarray
    deviation: np.ndarray


def _find(sorted_grams: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted gram, -1 where it is unknown."""
    if not len(sorted_grams):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(sorted_grams, wanted)
    at[at == len(sorted_grams)] = 0
    return np.where(sorted_grams[at] == wanted, at, -1)


def _levels(counts: DataFrame) -> list[DataFrame]:
    """Rows (lang, gram, n, total) of every order that the model keeps, from counts (lang, gram, n) of all 4-grams.

    n counts occurrences of a 4-gram, and different left neighbours of shorter ones; total is the sum over
    everything seen in the same context. Both are taken over all grams, also those that are not kept.
    """
    orders = [counts]
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("long")).alias("gram")
        orders.insert(0, orders[0].select("lang", shorter).groupBy("lang", "gram").agg(F.count("*").alias("n")))
    out: list[DataFrame] = []
    ends = None
    for k in range(ORDER - 1, -1, -1):
        kept = orders[k]
        if k > 1:
            least = kept.groupBy("lang").agg((F.sum("n") * MIN_SHARE).alias("least"))  # one row a language
            kept = kept.join(F.broadcast(least), "lang").where("n >= least").select("lang", "gram", "n")
            if ends is not None:  # every shorter gram of a kept one is kept
                kept = kept.union(orders[k].join(ends, ["lang", "gram"], "left_semi")).distinct()
        kept = keep(kept, f"grams{k + 1}")
        ends = kept.select("lang", F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("long")).alias("gram")).distinct()
        totals = orders[k].groupBy("lang", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"))
        out.insert(0, kept.withColumn("context", F.shiftright("gram", 8)).join(totals, ["lang", "context"]).select("lang", "gram", "n", "total"))
    return out


def _kneser_ney(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """Modified only in that one discount serves all orders. `counts` has language, gram, count and context total of each
    order; what the kept grams of a context leave goes to the shorter one."""
    floor = 1.0 / 256
    all_grams, all_logs, all_contexts, all_backoff = [], [], [], []
    lower_grams = lower = None
    for k in range(ORDER):
        at_lang, at_gram, c, context_total = counts[k]
        known = np.unique(at_gram)
        contexts = np.unique(at_gram >> np.uint32(8)) if k else np.zeros(1, np.uint32)
        total = np.zeros((len(contexts), len(langs)))
        given = np.zeros((len(contexts), len(langs)))
        context_of = np.searchsorted(contexts, at_gram >> np.uint32(8)) if k else np.zeros(len(at_gram), np.int64)
        total[context_of, at_lang] = context_total
        np.add.at(given, (context_of, at_lang), np.maximum(c - DISCOUNT, 0))
        seen = total > 0
        weight = np.where(seen, 1 - given / np.where(seen, total, 1.0), 1.0)
        own = np.zeros((len(known), len(langs)))
        rows = np.searchsorted(known, at_gram)
        own[rows, at_lang] = np.maximum(c - DISCOUNT, 0) / total[context_of, at_lang]
        of = np.searchsorted(contexts, known >> np.uint32(8)) if k else np.zeros(len(known), np.int64)
        if k:
            below = _find(lower_grams, known & np.uint32((1 << (8 * k)) - 1))
            p = own + weight[of] * lower[below]  # every shorter gram of a known one is known
        else:
            p = own + weight[of] * floor
        all_grams.append(known)
        all_logs.append(np.log(p).astype(np.float32))
        all_contexts.append(contexts)
        all_backoff.append(np.log(weight).astype(np.float32))
        lower_grams, lower = known, p
    zero = np.zeros(len(langs))
    return Model(langs, all_grams, all_logs, all_contexts, all_backoff, float(np.log(floor)), zero, zero)


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean negative log probability per character of each text in each language, and each text's letters."""
    gram, count, letters = grams(texts)
    sums = np.zeros((len(texts), len(model.langs)))
    if len(gram):
        at = _find(model.grams[-1], gram)
        logs = model.logs[-1][at]
        rest = np.flatnonzero(at < 0)
        logs[rest] = 0
        for k in range(ORDER - 1, -1, -1):  # back off from contexts of k characters
            if not len(rest):
                break
            wanted = gram[rest]
            context = _find(model.contexts[k], (wanted & np.uint32((1 << (8 * (k + 1)) if k < 3 else 1 << 32) - 1)) >> np.uint32(8))
            logs[rest] += np.where((context >= 0)[:, None], model.backoff[k][context], 0)
            if k == 0:
                logs[rest] += model.floor
                break
            below = _find(model.grams[k - 1], wanted & np.uint32((1 << (8 * k)) - 1))
            logs[rest] += np.where((below >= 0)[:, None], model.logs[k - 1][below], 0)
            rest = rest[below < 0]
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])
        some = count > 0
        sums[some] = np.add.reduceat(logs, starts[some], axis=0, dtype=np.float64)
    return -sums / np.maximum(count, 1)[:, None], letters


def _label(model: Model, texts: pd.Series) -> pd.DataFrame:
    if not model.langs:
        return pd.DataFrame({"lang_pred": UNDETERMINED, "score": 0.0, "cross_entropy": np.nan, "rejected": True}, index=range(len(texts)))
    plain = [t if isinstance(t, str) else "" for t in texts]
    cross, letters = entropies(model, plain)
    none = letters == 0
    best = cross.argmin(axis=1)
    least = cross[np.arange(len(best)), best]
    # posterior of the winner with the evidence of at most 50 characters: longer texts are not surer than that
    evidence = np.minimum(np.maximum(letters, 1), 50)[:, None]
    score = 1 / np.exp((least[:, None] - cross) * evidence).sum(axis=1)
    names = np.array([*model.langs, UNDETERMINED], dtype=object)
    where = np.where(none, len(model.langs), best)
    odd = (letters >= MIN_LETTERS) & (least > model.mean[best] + REJECT_SIGMAS * model.deviation[best])
    return pd.DataFrame({
        "lang_pred": names[where], "score": np.where(none, 0.0, score), "cross_entropy": np.where(none, np.nan, least),
        "rejected": none | odd,
    })


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count every row of `train` with text and language, and fix the rejection levels on every one of them.

    Rows with null text or language teach nothing. Without any such row the model knows no language.
    """
    rows = train.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    ship(train.sparkSession)
    counted = rows.mapInPandas(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    levels = [frame.toPandas() for frame in _levels(keep(counted, "grams"))]  # bounded by MIN_SHARE, a language
    langs = sorted(levels[0].lang.unique())
    of = {name: k for k, name in enumerate(langs)}
    model = _kneser_ney(langs, [
        (x.lang.map(of).to_numpy(np.int64), x.gram.to_numpy(np.int64).astype(np.uint32), x.n.to_numpy(np.float64), x.total.to_numpy(np.float64)) for x in levels])
    if not langs:
        return model

    def calibrate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            cross, letters = entropies(held.value, frame.text.tolist())
            # a language none of whose texts has a letter is not in the model
            number = frame.lang.map(of)
            own = cross[np.arange(len(frame)), number.fillna(0).to_numpy(np.int64)]
            yield pd.DataFrame({"lang": frame.lang, "e": own})[(letters >= MIN_LETTERS) & number.notna().to_numpy()]

    held = train.sparkSession.sparkContext.broadcast(model)
    own = rows.select("lang", "text").mapInPandas(calibrate, "lang string, e double")
    found = {r.lang: r for r in own.groupBy("lang").agg(F.avg("e").alias("m"), F.stddev("e").alias("s")).collect()}
    model.mean = np.array([found[x].m if x in found else np.inf for x in langs])
    model.deviation = np.array([(found[x].s or 0.0) if x in found else 0.0 for x in langs])
    model.deviation = np.maximum(model.deviation, LEAST_DEVIATION)
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from: crc32 of the id's text leaves 1 when divided by 3 (null ids: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """Every row of `docs` with lang_pred, score, cross_entropy and rejected (names preceded by `prefix`).

    lang_pred: the language of least cross-entropy per character, ties to the name that sorts first; `und` for null
    texts and texts without a letter, which have score 0 and are rejected. score: share of the winner in the
    posterior, with the evidence of 50 characters at most. rejected also holds for texts of MIN_LETTERS letters and
    more whose cross-entropy is far above what the language's own documents have. Columns of `docs` that have the new
    names are replaced. A model that knows no language answers `und`.
    """
    new = {"lang_pred": "string", "score": "double", "cross_entropy": "double", "rejected": "boolean"}
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(*(prefix + name for name in new))
    rows = kept.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept.columns)), F.col(text).cast("string").alias("text"))
    schema = ", ".join([*(f"c{k} {kept.schema[c].dataType.simpleString()}" for k, c in enumerate(kept.columns)), *(f"`{prefix}{n}` {t}" for n, t in new.items())])

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in text_blocks(frames, "text"):
            labels = _label(held.value, frame.text).add_prefix(prefix).set_axis(frame.index)
            yield pd.concat([frame.drop(columns="text"), labels], axis=1)

    out = rows.mapInPandas(label, schema)
    return out.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(kept.columns)), *(prefix + n for n in new))
