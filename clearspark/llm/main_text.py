"""The main text of web pages: the contiguous region with the greatest sum of scores.

A page is a row of words and tags. A word scores as often as words of its kind (block, in a
link or not, beside the main text or not) belong to the article of labelled pages; a tag
scores below zero, as often as it stands outside of it. One linear scan finds the region with
the greatest sum; of its text, what stands in elements beside the main text is left out.
Labelled are the pages whose own markup names one article; the weights don't see that markup.
"""

from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspark.llm.markup import Piece, blocks, pieces
from clearspark.llm.names import free
from clearspark.session import landed

#: What a tag outside the article costs in words, tried on the labelled pages.
COSTS = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0)
#: Before any page is seen: the share of words in the article, by kind, and that of tags outside, with their weight in pages' counts.
_PRIOR = 20.0
_MARKS = frozenset(["article", "/article", "main", "/main"])
#: Tags of running text.
_PROSE = frozenset("b blockquote br cite code em h1 h2 h3 h4 h5 h6 i p pre q s small strong sub sup u".split())


@dataclass
class Model:
    """Scores of words by kind and of tags, and what a tag costs."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    cost: float = 2.0

    def word(self, kind: str) -> float:
        return self.words.get(kind) or _word_prior(kind)

    def tag(self, name: str) -> float:
        return -self.cost * self.tags.get(name, _tag_prior(name))


def _word_prior(kind: str) -> float:
    """Words beside the main text hardly count, links little, paragraphs most."""
    block, link, shut = kind.split("|")
    if shut:
        return 0.01
    if link:
        return 0.1
    return 0.9 if block in ("p", "blockquote", "pre") else 0.5


def _tag_prior(name: str) -> float:
    if name in _MARKS:
        return 0.0
    return 0.1 if name.lstrip("/") in _PROSE else 0.5


def kind_of(piece: Piece) -> str:
    return f"{piece.name}|{'link' if piece.link else ''}|{'shut' if piece.shut else ''}"


def _size(piece: Piece) -> int:
    return len(piece.text.split())


def region(row: list[Piece], model: Model) -> tuple[int, int]:
    """First and past-last piece of the region with the greatest sum; the earliest of ties, (0, 0) without words."""
    best, total, start, found = 0.0, 0.0, 0, (0, 0)
    for i, piece in enumerate(row):
        if total <= 0.0:
            total, start = 0.0, i
        if piece.text is None:
            total += model.tag(piece.name)
        else:
            total += model.word(kind_of(piece)) * _size(piece)
            if total > best:
                best, found = total, (start, i + 1)
    return found


def main_text(page: str, model: Model) -> str:
    """Where every word stands beside the main text, the elements' names are not to be trusted: all words take part."""
    row = pieces(page)
    if not any(p.text is not None and not p.shut and p.text.strip() for p in row):
        for p in row:
            p.shut = False
    a, b = region(row, model)
    return blocks(row[a:b])


def _labels(row: list[Piece]) -> bool:
    """Whether the page's markup names one article that holds some of its words."""
    inner = [i for i, p in enumerate(row) if p.text is not None and p.marked and not p.shut and p.text.strip()]
    return bool(inner) and sum(p.name in ("article", "main") for p in row if p.text is None) <= 2


def _sample(pages: DataFrame, most: int, html: str) -> DataFrame:
    """At most `most` different pages that may be labelled, those with the smallest hashes."""
    content = F.col(html)
    marked = content.rlike(r"(?i)<(article|main)[\s>]|role=.?(article|main)|articlebody")
    found = pages.filter(marked).select(content.alias("html"), F.xxhash64(content).alias("h"))
    hashes = found.select("h").distinct().orderBy("h").limit(most)
    last = hashes.agg(F.max("h")).first()[0]
    if last is None:
        return found.limit(0).select("html")
    return landed(found.filter(F.col("h") <= last).groupBy("h").agg(F.first("html").alias("html")).select("html"), "labelled-pages")


def fit(pages: DataFrame, html: str = "html", most: int = 2000) -> Model:
    """Weights from at most `most` labelled pages; without any the scores set beforehand."""
    sample = _sample(pages, most, html)

    def counted(batches):
        for batch in batches:
            within, without = Counter(), Counter()
            for page in batch.column(0).to_pylist():
                row = pieces(page)
                if not _labels(row):
                    continue
                places = [i for i, p in enumerate(row) if p.text is not None and p.marked and not p.shut]
                first, last = places[0], places[-1]
                for i, piece in enumerate(row):
                    if piece.text is None:
                        (within if first <= i <= last else without)["<" + piece.name] += 1
                    elif n := _size(piece):
                        (within if piece.marked and not piece.shut else without)[kind_of(piece)] += n
            listed = [*({*within, *without})]
            yield pa.RecordBatch.from_arrays(
                [pa.array(listed, pa.string()), pa.array([within[k] for k in listed], pa.int64()), pa.array([without[k] for k in listed], pa.int64())],
                names=["kind", "within", "without"],
            )

    rows = sample.mapInArrow(counted, "kind string, within bigint, without bigint")
    # Names that few pages use are no kinds: custom elements are without bound.
    sums = rows.groupBy("kind").agg(F.sum("within").alias("within"), F.sum("without").alias("without")).orderBy(F.desc(F.col("within") + F.col("without"))).limit(1000)
    words, tags = {}, {}
    for kind, within, without in sums.collect():
        share = within + without + _PRIOR
        if kind.startswith("<"):
            if kind[1:] not in _MARKS:
                tags[kind[1:]] = (without + _PRIOR * _tag_prior(kind[1:])) / share
        else:
            words[kind] = (within + _PRIOR * _word_prior(kind)) / share

    def tried(batches):
        for batch in batches:
            total = [0.0] * len(COSTS)
            for page in batch.column(0).to_pylist():
                row = pieces(page)
                if not _labels(row):
                    continue
                wanted = sum(_size(p) for p in row if p.text is not None and p.marked and not p.shut)
                for k, cost in enumerate(COSTS):
                    a, b = region(row, Model(words, tags, cost))
                    own = [p for p in row[a:b] if p.text is not None and not p.shut]
                    hit = sum(_size(p) for p in own if p.marked)
                    total[k] += 2 * hit / max(1, wanted + sum(map(_size, own)))
            yield pa.RecordBatch.from_arrays([pa.array(COSTS, pa.float64()), pa.array(total, pa.float64())], names=["cost", "f"])

    scores = sample.mapInArrow(tried, "cost double, f double").groupBy("cost").agg(F.sum("f").alias("f")).collect()
    best = max(((r["f"], r["cost"]) for r in scores if r["f"]), default=(0.0, Model.cost))
    return Model(words, tags, best[1])


def extract(pages: DataFrame, model: Model, keep: list[str], html: str = "html") -> DataFrame:
    """The columns `keep` with `text` and `n_chars` (underscores added where kept columns have the names).

    Null, empty and white pages, and pages of markup alone, have empty text. A page
    without markup is one block. Broken markup never fails. Rows stay as they are.
    """
    kept = len(keep)
    names = free(keep, "text", "n_chars")
    (content,) = free(keep, "_html")

    def extracted(batches):
        for batch in batches:
            texts, seen = [], {}
            for page in batch.column(kept):
                page = page.as_py()
                if page not in seen:
                    if len(seen) > 1000:
                        seen.clear()
                    seen[page] = main_text(page, model)
                texts.append(seen[page])
            columns = [*batch.columns[:kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    schema = pages.select(*keep).schema.add(names[0], "string").add(names[1], "long")
    return pages.select(*keep, F.coalesce(F.col(html), F.lit("")).alias(content)).mapInArrow(extracted, schema)
