"""Personal data by pattern, and terms that reveal it by corpus co-occurrence; DataFrame functions only.

Base spans are the matches of four patterns that pass their checks. Their values are the
protected entities. A term (letters outside e-mails) of a text that holds an entity discloses
it by the share PMI(term; entity) / IC(entity) = 1 + ln(n_te / n_t) / ln(N / n_e), counted in
whole documents of the corpus: 1 when the term occurs with no other. Terms at or above the
threshold in enough distinct texts are spans too, wherever they stand in any document.

What is found depends on the text alone, so all steps work on distinct texts that carry the
number of their copies; pairs are folded before they are shuffled.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearspark.llm.names import free
from clearspark.session import landed

#: Kinds in their order. Quantifiers are possessive where nothing that follows could take
#: the character back, and a start inside a run that failed as a whole is not tried.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
TERM = r"\p{L}{3,}"
#: A term or, so that its letters are no terms, a whole e-mail.
WORD = f"{PATTERNS['email']}|{TERM}"
#: What replaces a span of each kind.
LABELS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}


def _matches(text: Column, kind: str) -> Column:
    """The matches of one kind: characters since the last match, and value."""
    pattern = F.lit(PATTERNS[kind])
    may = F.contains(text, F.lit("@" if kind == "email" else "+")) if kind in ("email", "phone") else text.rlike("[0-9]")
    values = F.when(may, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    pieces = F.when(may, F.split(text, PATTERNS[kind], -1)).otherwise(F.array().cast("array<string>"))
    sides = F.transform(pieces, lambda p, i: F.struct(i.alias("i"), F.char_length(p).alias("gap")))
    return F.zip_with(values, sides, lambda v, p: F.struct(v.alias("value"), p["i"].alias("i"), p["gap"].alias("gap")))


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, and the others sum to a multiple of ten."""

    def worth(d, i):
        twice = d.cast("int") * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d.cast("int"))

    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    small = F.forall(
        F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "")), lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")).cast("int"), F.lit(0)) <= 255)
    )
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", F.when((size >= 13) & (size <= 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", (size >= 9) & (size <= 15))
        .otherwise(True)
    )


def _entity(kind: Column, value: Column) -> Column:
    """One spelling for each protected entity."""
    bare = F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(F.regexp_replace(value, "[^0-9]", ""))
    return F.concat_ws(":", kind, bare)


def _scanned(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """`keep`, two hashes of the text and the raw matches of each kind; null where there are none."""
    content = F.coalesce(F.col(text), F.lit(""))
    each = [_matches(content, k).alias(f"_{k}") for k in PATTERNS]
    rows = docs.select(*[F.col(c) for c in keep], F.xxhash64(content).alias("_a"), F.xxhash64(F.lit("b"), content).alias("_b"), *each)
    return rows


def _explode(hits: DataFrame) -> DataFrame:
    """One row for each valid base span of each distinct text."""
    fields = ("i", "value", "gap")

    def named(kind):
        return F.transform(f"_{kind}", lambda m: F.struct(F.lit(kind).alias("kind"), *[m[f].alias(f) for f in fields]))

    kinds = F.flatten(F.array(*map(named, PATTERNS)))
    rows = hits.select("_a", "_b", "copies", F.explode(kinds).alias("m")).select("_a", "_b", "copies", "m.*")
    by = Window.partitionBy("_a", "_b", "kind").orderBy("i")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    passed = by.rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("value")
    start = F.sum("gap").over(so_far) + F.coalesce(F.sum(length).over(passed), F.lit(0))
    rows = rows.withColumn("start", start)
    rows = rows.filter(F.col("value").isNotNull()).withColumn("end", F.col("start") + length)
    return rows.filter(_valid(F.col("kind"), F.col("value"))).withColumn("entity", _entity(F.col("kind"), F.col("value")))


def _words(text: Column) -> Column:
    """The terms of a text outside its e-mails, as hashes; null in place of each e-mail."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.when(~F.contains(w, F.lit("@")), F.xxhash64(F.lower(w))))


def _told(terms: DataFrame, base: DataFrame, total: int, threshold: float, support: int) -> DataFrame:
    """(h) of the terms that disclose an entity, over whole distinct texts (_a, _b, copies, hs).

    An entity in fewer than `support` distinct texts has no such term and takes no part.
    """
    held = base.select("_a", "_b", "copies", "entity").distinct()
    n_e = held.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("_texts"))
    n_e = landed(n_e.filter((F.col("_texts") >= support) & (F.col("n_e") < total)), "entities")
    several = held.join(n_e, "entity").groupBy("_a", "_b").agg(F.collect_list("entity").alias("entities"))
    pairs = terms.join(several, ["_a", "_b"]).select("copies", "entities", F.explode("hs").alias("h"))
    pairs = pairs.select("copies", "h", F.explode("entities").alias("entity"))
    together = pairs.groupBy("entity", "h").agg(F.count("*").alias("texts"), F.sum("copies").alias("n_te"))
    together = landed(together.filter(F.col("texts") >= support), "together")
    n_t = terms.select("copies", F.explode("hs").alias("h")).groupBy("h").agg(F.sum("copies").alias("n_t"))
    share = 1 + F.log(F.col("n_te") / F.greatest("n_t", "n_te")) / F.log(F.lit(float(max(total, 1))) / F.col("n_e"))
    return together.join(n_t, "h").join(n_e, "entity").filter(share >= threshold).select("h").distinct()


def spans(docs: DataFrame, scanned: DataFrame, text: str, threshold: float, support: int) -> DataFrame:
    """(_a, _b, copies, kind, start, end) of the base spans and disclosing terms of each distinct text."""
    several = F.greatest(*[F.size(f"_{k}") for k in PATTERNS]) > 0
    hits = scanned.filter(several).groupBy("_a", "_b").agg(F.count("*").alias("copies"), *[F.first(f"_{k}").alias(f"_{k}") for k in PATTERNS])
    base = landed(_explode(hits), "base-spans")
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(content).alias("_a"), F.xxhash64(F.lit("b"), content).alias("_b"), content.alias("_text"))
    terms = rows.select("_a", "_b", F.array_compact(F.array_distinct(_words(F.col("_text")))).alias("hs"))
    terms = landed(terms.groupBy("_a", "_b").agg(F.count("*").alias("copies"), F.first("hs").alias("hs")), "terms")
    told = landed(_told(terms, base, docs.count(), threshold, support), "told")
    marked = terms.select("_a", "_b", "copies", F.explode("hs").alias("h")).join(told, "h").select("_a", "_b", "copies").distinct()
    marked = landed(marked, "marked")
    # Rows of a hot text are joined and folded before their words are laid out.
    texts = rows.join(marked, ["_a", "_b"]).groupBy("_a", "_b").agg(F.first("copies").alias("copies"), F.first("_text").alias("_text"))
    found = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    pieces = F.split("_text", WORD, -1)
    placed = F.zip_with(pieces, found, lambda p, w: F.struct(F.char_length(p).alias("gap"), F.char_length(w).alias("length")))
    placed = F.zip_with(placed, _words(F.col("_text")), lambda p, h: F.struct(p["gap"].alias("gap"), p["length"].alias("length"), h.alias("h")))
    each = texts.select("_a", "_b", "copies", F.posexplode(placed).alias("i", "w")).select("_a", "_b", "copies", "i", "w.*")
    by = Window.partitionBy("_a", "_b").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum(F.col("gap") + F.coalesce("length", F.lit(0))).over(by)).filter("h IS NOT NULL")
    each = each.join(told, "h").select("_a", "_b", "copies", F.lit("term").alias("kind"), (F.col("end") - F.col("length")).alias("start"), "end")
    return base.select("_a", "_b", "copies", "kind", "start", "end").unionByName(each)


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(found: str, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)


def _by_text(found: DataFrame) -> DataFrame:
    """The spans of each distinct text, in order of kind and start."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    each = F.struct(rank.alias("rank"), F.col("start"), F.col("end"), F.col("kind"))
    return found.groupBy("_a", "_b").agg(F.array_sort(F.collect_list(each)).alias("_found"))


def find(
    docs: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.8, support: int = 2
) -> DataFrame:
    """The columns `keep` with n_email, n_ip, n_card, n_phone, n_term, base_sha256 and spans.

    Spans are kind:start:end in code points, end exclusive, by kind and start, joined with
    commas; base_sha256 is the digest of those of the four patterns. Null and empty texts
    have none. Every row is kept, repeated ones too.
    """
    rows = landed(_scanned(docs, keep, text), "scanned")
    found = _by_text(spans(docs, rows, text, threshold, support))
    both = rows.select(*keep, "_a", "_b").join(found, ["_a", "_b"], "left").select(*keep, F.coalesce("_found", F.array()).alias("_found"))
    base = F.filter("_found", lambda s: s["kind"] != "term")
    counts = [F.size(_of("_found", k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return both.select(*keep, *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("_found")).alias("spans"))


def sanitise(docs: DataFrame, text: str = "text", threshold: float = 0.8, support: int = 2) -> DataFrame:
    """The rows with every span of the text replaced by its kind's label; overlapping spans leave one label each.

    Rows without a span, null texts among them, stay as they are.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    scanned = landed(_scanned(docs, [], text), "scanned")
    found = spans(docs, scanned, text, threshold, support)
    order = F.array_sort(F.collect_list(F.struct("start", "end", "kind")))
    found = landed(found.groupBy("_a", "_b").agg(order.alias("_found")), "spans")
    names = docs.columns
    a, b, own = free(names, "_a", "_b", "_found")
    found = found.select(F.col("_a").alias(a), F.col("_b").alias(b), F.col("_found").alias(own))
    marked = docs.withColumn(a, F.xxhash64(content)).withColumn(b, F.xxhash64(F.lit("b"), content))
    marked = marked.join(found, [a, b], "left")
    label = F.create_map(*[F.lit(x) for k in KINDS for x in (k, LABELS[k])])
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def put(acc, s):
        gap = F.greatest(s["start"] - acc["at"], F.lit(0))
        kept = F.substring(F.col(text), (acc["at"] + 1).cast("int"), gap.cast("int"))
        return F.struct(F.concat(acc["out"], kept, F.try_element_at(label, s["kind"])).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), F.char_length(F.col(text))))

    changed = F.when(F.col(own).isNull(), F.col(text)).otherwise(F.aggregate(own, state, put, finish))
    return marked.withColumn(text, changed).select(*names)
