"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the characters of its words (runs of letters in lower case,
an edge before and after). The models share sorted hash arrays: an n-gram's row has its
interpolated probability under each language. A text goes to the language with the lowest
cross-entropy for each character; it is rejected where even that is higher than texts of
the language reach.
"""

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clearspark.llm.backoff import Backoff, WordScores, find, framed
from clearspark.llm.names import free
from clearspark.llm.pretokens import SLICE, _lower, hashed, slices

ORDER = 5
EDGE = 32
UNKNOWN = "und"
#: Characters of the effective length for the confidence of a long text.
CONFIDENT = 40
#: Share of calibration texts beyond the limits, which are widened by the slack.
TAIL, SLACK = 0.005, 2.0


@functools.cache
def _letters() -> np.ndarray:
    """0: no part of a word; 1: mark; 2: letter."""
    kinds = {"L": 2, "M": 1}
    return np.fromiter((kinds.get(unicodedata.category(chr(p))[0], 0) for p in range(0x110000)), np.uint8, 0x110000)


class Runs:
    """The words of some texts as code points, hashes and the first word of each text."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _letters()[points]
        self.symbols = _lower()[points]
        solid = np.zeros(len(points) + 2, np.int8)
        solid[1:-1] = kinds > 0
        steps = np.diff(solid)
        self.starts, self.ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.hashes = hashed(self.symbols, self.starts, self.ends)
        edges = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.firsts = np.searchsorted(self.starts, np.append(0, edges))
        letters = np.append(0, np.cumsum(kinds == 2))
        self.lettered = np.diff(letters[np.append(0, edges)]) > 0


def _counted(words: list[np.ndarray], counts: np.ndarray) -> list[dict]:
    """Kneser-Ney parts of one language, by order from 1."""
    symbols, places, within = framed(words, EDGE)
    weight = np.repeat(counts, np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))
    found: list[dict] = []
    for n in range(1, ORDER + 1):
        fits = within + 1 >= n
        at = places[fits]
        grams, first, which = np.unique(hashed(symbols, at - n + 1, at + 1), return_index=True, return_inverse=True)
        raw = np.bincount(which, weight[fits], len(grams))
        found.append({"grams": grams, "at": at[first], "counts": raw, "fixed": (within[fits][first] + 1 == n) & (n > 1)})
    for n in range(1, ORDER):
        low, high = found[n - 1], found[n]
        left = find(low["grams"], hashed(symbols, high["at"] - n + 1, high["at"] + 1))
        follows = np.bincount(left, minlength=len(low["grams"])).astype(float)
        # What begins a word has no left neighbour and keeps its own count.
        low["counts"] = np.where(low["fixed"] | (follows == 0), low["counts"], follows)
    for n, part in enumerate(found, 1):
        counts, at = part["counts"], part["at"]
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.9))
        part["context"] = hashed(symbols, at - n + 1, at)
        part["suffix"] = hashed(symbols, at - n + 2, at + 1) if n > 1 else None
        contexts, which = np.unique(part["context"], return_inverse=True)
        total = np.bincount(which, counts)
        part["share"] = np.maximum(counts - discount, 0) / total[which]
        part["contexts"], part["weights"] = contexts, discount * np.bincount(which) / total
    return found


def kneser_ney(words: dict[str, tuple[list[np.ndarray], np.ndarray]]) -> Backoff:
    """One model of all languages from each one's distinct words and their counts."""
    each = [_counted(*w) for w in words.values()]
    alphabet = len(np.unique(np.concatenate([e[0]["grams"] for e in each]))) + 1
    lists = {name: np.unique(np.concatenate([p[name] for e in each for p in e])) for name in ("grams", "contexts")}
    weights = np.ones((len(lists["contexts"]), len(each)))
    for k, e in enumerate(each):
        for part in e:
            weights[find(lists["contexts"], part["contexts"]), k] = part["weights"]
    chances = np.zeros((len(lists["grams"]), len(each)))
    root = find(lists["contexts"], each[0][0]["contexts"])[0]
    for n in range(ORDER):
        for k, e in enumerate(each):
            chances[find(lists["grams"], e[n]["grams"]), k] = e[n]["share"]
        mine = np.concatenate([e[n]["grams"] for e in each])
        mine, first = np.unique(mine, return_index=True)
        context = np.concatenate([e[n]["context"] for e in each])[first]
        lower = 1.0 / alphabet
        if n:
            suffix = np.concatenate([e[n]["suffix"] for e in each])[first]
            lower = chances[find(lists["grams"], suffix)]
        chances[find(lists["grams"], mine)] += weights[find(lists["contexts"], context)] * lower
    # At order one the empty context's weight is added before the floor.
    floor = np.full(len(each), -np.log10(alphabet))
    assert root >= 0
    return Backoff(
        ORDER, lists["grams"], np.log10(chances).astype(np.float32), lists["contexts"], np.log10(weights).astype(np.float32), floor
    )


class Identifier:
    """The models of some languages and the cross-entropies their texts reach."""

    def __init__(self, languages: list[str], model: Backoff | None):
        self.languages, self.model = languages, model
        self.usual = self.long = self.short = np.zeros(len(languages))
        self.cache: WordScores | None = None

    def __getstate__(self):
        return {**self.__dict__, "cache": None}

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits for each character under each language, characters, whether any is a letter."""
        self.cache = self.cache or WordScores(self.model, EDGE)
        bits, sizes, lettered = [], [], []
        for a, b in slices([len(t) for t in texts]):
            runs = Runs(texts[a:b])
            scores = self.cache.of(runs.hashes, runs.symbols, runs.starts, runs.ends)
            n = np.append(0, np.cumsum(runs.ends - runs.starts + 1))[runs.firsts]
            sums = np.zeros((len(scores) + 1, scores.shape[1]))
            np.cumsum(scores, 0, np.float64, sums[1:])
            sizes.append(np.diff(n))
            bits.append(-np.diff(sums[runs.firsts], axis=0) * np.log2(10) / np.maximum(sizes[-1], 1)[:, None])
            lettered.append(runs.lettered)
        if not texts:
            return np.zeros((0, len(self.languages))), np.zeros(0, int), np.zeros(0, bool)
        return np.concatenate(bits), np.concatenate(sizes), np.concatenate(lettered)

    def calibrate(self, texts: list[str], languages: list[str]) -> None:
        """Limits of each language from labelled texts that its model was not fitted on."""
        bits, sizes, lettered = self.entropies(texts)
        own = np.array([self.languages.index(x) for x in languages])
        usual, long, short = [], [], []
        for k in range(len(self.languages)):
            rows = np.flatnonzero((own == k) & lettered)
            mine, n = (bits[rows, k], sizes[rows]) if len(rows) else (bits.reshape(-1), np.ones(bits.size))
            centre = float(np.median(mine)) if len(mine) else np.inf
            over = np.maximum(mine - centre, 0)
            usual.append(centre)
            long.append(float(np.quantile(over, 1 - TAIL)) if len(mine) else 0)
            short.append(float(np.quantile(over * np.sqrt(n), 1 - TAIL)) if len(mine) else 0)
        self.usual, self.long, self.short = map(np.array, (usual, long, short))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, confidence from 0 to 1 and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        bits, sizes, lettered = self.entropies([t or "" for t in texts])
        best = bits.argmin(1) if len(bits) else np.zeros(0, int)
        lowest = bits.min(1) if len(bits) else np.zeros(0)
        odds = np.exp2(-(bits - lowest[:, None]) * np.minimum(sizes, CONFIDENT)[:, None])
        score = np.where(lettered, 1 / np.maximum(odds.sum(1), 1), 0.0)
        limit = self.usual[best] + SLACK * (self.long[best] + self.short[best] / np.sqrt(np.maximum(sizes, 1)))
        rejected = ~lettered | (lowest > limit)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, score, rejected


def fit(
    rows: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 800, held: int = 200, chars: int = 8_000_000
) -> Identifier:
    """The identifier of the languages in `lang`, from a bounded sample of labelled rows.

    Of each language the `sample` texts whose hash is smallest are fitted and the `held`
    next ones calibrate the rejection; texts past `chars` characters of a language are left
    out of the sample. Rows with null text or lang teach nothing. No labelled row: no
    language, and every text is rejected as unknown.
    """
    order = F.shiftrightunsigned(F.xxhash64(key, text), 1)
    labelled = rows.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), order.alias("_order"))
    labelled = labelled.filter("_lang IS NOT NULL AND _text IS NOT NULL")
    # Three times as many as wanted are below this share of the hashes, so few rows are ranked.
    # The counts go through the driver, as the model does: one for each language.
    counts = labelled.groupBy("_lang").count().collect()
    most = [F.lit(x) for r in counts for x in (r["_lang"], 3.0 * (sample + held) * 2**63 / r["count"])]
    if most:
        labelled = labelled.filter(F.col("_order") < F.try_element_at(F.create_map(*most), F.col("_lang")))
    by = Window.partitionBy("_lang").orderBy("_order", "_text")
    ranked = labelled.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= sample + held)
    sizes = F.sum(F.length("_text")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    chosen = ranked.withColumn("_before", F.coalesce(sizes, F.lit(0))).filter(F.col("_before") < chars)
    texts = chosen.select("_lang", "_text", "_rank").toPandas().sort_values(["_lang", "_rank"])
    words, languages = {}, sorted(set(texts["_lang"]))
    for name in languages:
        own = texts[(texts["_lang"] == name) & (texts["_rank"] <= sample)]["_text"].tolist()
        parts = [_words(own[a:b]) for a, b in slices([len(t) for t in own])]
        both = pd.concat(parts, ignore_index=True).groupby("word", sort=True)["n"].sum()
        words[name] = ([np.array([ord(c) for c in w], np.uint32) for w in both.index], both.to_numpy(float))
    words = {name: w for name, w in words.items() if len(w[0])}
    languages = list(words)
    found = Identifier(languages, kneser_ney(words) if words else None)
    if words:
        rest = texts[(texts["_rank"] > sample) & texts["_lang"].isin(languages)]
        rest = rest if len(rest) else texts[texts["_lang"].isin(languages)]
        found.calibrate(rest["_text"].tolist(), rest["_lang"].tolist())
    found.cache = None
    return found


def _words(texts: list[str]) -> pd.DataFrame:
    runs = Runs(texts)
    new, first, n = np.unique(runs.hashes, return_index=True, return_counts=True)
    word = ["".join(map(chr, runs.symbols[runs.starts[k] : runs.ends[k]])) for k in first.tolist()]
    return pd.DataFrame({"word": word, "n": n})



def identify(
    rows: DataFrame,
    model: Identifier,
    text: str = "text",
    keep: list[str] | None = None,
    into: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
) -> DataFrame:
    """The columns `keep` (default: all) with the language, the score and the rejection, named `into`.

    Null texts and texts without a letter are `und` with score 0, and rejected. Whole texts
    are scored; no shuffle. The model is bounded by its sample and sent to the tasks once.
    Only the text goes to Python and only the result comes back: the kept columns, a text
    among them, are never copied through Arrow.
    """
    keep = keep if keep is not None else rows.columns
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kind = StructType().add(into[0], "string").add(into[1], "double").add(into[2], "boolean")

    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for texts in batches:
            parts = [own.predict(part.to_pylist()) for part in _stretches(texts)]
            names = [n for part in parts for n in part[0]]
            score, rejected = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (1, 2))
            columns = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected.astype(bool), pa.bool_())]
            yield pa.StructArray.from_arrays(columns, names=list(into))

    # Else a later filter on the result is pushed below and the texts are scored twice.
    found = F.arrow_udf(predicted, kind).asNondeterministic()
    (result,) = free([*keep, *into], "result")
    scored = rows.select(*keep, found(F.col(text)).alias(result))
    return scored.select("*", *(F.col(result)[x].alias(x) for x in into)).drop(result)


def _stretches(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in stretches that are handled as one array, so that few are Python strings at a time."""
    for a, b in slices(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), SLICE):
        yield texts.slice(a, b - a)
