r"""Personal data: base patterns, and terms that give it away. Built-in expressions only.

Base spans are found by pattern (email, ip, card, phone; leftmost, not
overlapping within a kind; matches that fail their check are dropped). Each is
an entity. Which words give an entity away is estimated over the whole corpus:

* the unit is a word of a text that is not inside a base span, counted in every
  copy: n(t) is how often term t occurs, n the number of words;
* n(e, t): how many of the n(t) are near entity e, that is one of the `window`
  words on either side of it; n(e): how many of all words are. A word between
  two spans of e counts once;
* p(e | t) = n(e, t) / n(t), p(e) = n(e) / n, and

      disclosure(e, t) = log(p(e | t) / p(e)) / log(1 / p(e)),

  pointwise mutual information as a share of the entity's information: 1 if the
  term occurs near that entity only, 0 if it is independent of it (or if all
  words are near the entity).

Terms that occur `support` times or more near an entity which itself occurs as
often, and have a disclosure of `generalise_at`, are replaced by `[TERM]`, from
`remove_at` removed, in every text, whether it holds the entity or not.

The patterns are written with possessive quantifiers and, at their start, a
look at the character before, so that matching is linear in the text; they
match what the plain patterns match.

Defined results: null text is empty; no spans. Equal texts give equal spans, so
repeated rows, null ids and ties need no rule; spans are ordered by kind, then
start. Offsets are code points, end exclusive. Term spans that touch a base
span are left out. Input columns are kept; the added ones may not be among
them. Empty tables give empty results. Texts are searched whole.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import shared_dir

WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
BLOCK = 128
BROADCAST_BYTES = 1 << 25  # of marked terms, and of the texts' keys with their marked terms


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        number = F.ltrim(part, F.lit("0"))
        return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, "\\."), small)


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(digits, i, F.lit(1))) - 48
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


class Kind(NamedTuple):
    name: str
    hint: str  # every match holds a match of it
    pattern: str
    valid: Callable[[Column], Column]
    entity: Callable[[Column], Column]


LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    Kind("email", "@", f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), F.lower),
    Kind("ip", "[0-9]\\.[0-9]", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", _ip, lambda m: m),
    Kind("card", "[0-9]", "[0-9](?:[\\x20-]?[0-9])++", _luhn, _digits),
    Kind("phone", "\\+[0-9]", "\\+[0-9][\\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), _digits),
)


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running_sums(steps: Column) -> Column:
    """Inclusive running sums, in blocks, so that the work is far below the square of the length."""
    blocks = F.transform(
        F.sequence(F.lit(0), ((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def within(block: Column, carry: Column) -> Column:
        return F.transform(block, lambda _, j: carry + total(F.slice(block, F.lit(1), j + 1)))

    def joined(cut: Column) -> Column:
        sums = F.transform(cut, total)
        return _bind(sums, lambda s: F.flatten(F.transform(cut, lambda block, b: _bind(total(F.slice(s, F.lit(1), b)), lambda carry: within(block, carry)))))

    return F.when(F.size(steps) > 0, _bind(blocks, joined)).otherwise(F.array().cast("array<int>"))


def _starts(parts: Column, matches: Column) -> Column:
    """Where each match starts, from the texts between matches."""
    steps = F.transform(matches, lambda _, i: F.length(parts[i]) + F.when(i > 0, F.length(F.get(matches, i - 1))).otherwise(0))
    return _bind(steps, _running_sums)


NO_TEXTS = "array<string>"
FOUND = "array<struct<start:int,end:int,match:string>>"


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with one column of valid matches for each kind, named after it with two underscores in front."""
    body = F.coalesce(df[text], F.lit(""))
    own = [F.col(f"`{c}`") for c in df.columns]
    none = F.array().cast(NO_TEXTS)
    stage = df.select(
        *[df[c] for c in df.columns],
        body.alias("__body"),
        *[F.when(body.rlike(k.hint), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"__m_{k.name}") for k in KINDS],
    )
    stage = stage.select("*", *[
        F.when(F.size(f"__m_{k.name}") > 0, F.split("__body", k.pattern)).otherwise(none).alias(f"__p_{k.name}") for k in KINDS
    ])
    stage = stage.select("*", *[
        F.when(F.size(f"__m_{k.name}") > 0, _starts(F.col(f"__p_{k.name}"), F.col(f"__m_{k.name}"))).otherwise(F.array().cast("array<int>")).alias(f"__s_{k.name}")
        for k in KINDS
    ])

    def found(kind: Kind) -> Column:
        matches, parts, starts = (F.col(f"__{x}_{kind.name}") for x in "mps")
        rows = F.transform(matches, lambda m, i: F.struct(
            starts[i].alias("start"), (starts[i] + F.length(m)).alias("end"), m.alias("match")))
        return F.when(F.size(matches) > 0, F.filter(rows, lambda r: kind.valid(r["match"]))).otherwise(F.array().cast(FOUND))

    return stage.select(*own, *[found(k).alias(f"__{k.name}") for k in KINDS])


def base_spans() -> Column:
    """All base spans of a detected row: array of (kind, start, end), ordered."""
    def of(kind: Kind) -> Column:
        return F.transform(f"__{kind.name}", lambda r: F.struct(F.lit(kind.name).alias("kind"), r["start"].alias("start"), r["end"].alias("end")))

    return F.concat(*map(of, KINDS))


def _before(places: Column, at: Column) -> Column:
    """How many of the ascending `places` are below `at`, by bisection."""
    half = lambda r: F.shiftright(r["low"] + r["high"], 1)
    whole = F.struct(F.lit(0).alias("low"), F.size(places).alias("high"))

    def step(r: Column, _: Column) -> Column:
        return F.when(r["low"] >= r["high"], r).when(places[half(r)] < at, F.struct((half(r) + 1).alias("low"), r["high"].alias("high"))).otherwise(F.struct(r["low"].alias("low"), half(r).alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(places) + 1)).cast("int"))
    return F.aggregate(steps, whole, step, lambda r: r["low"])


def entity_contexts(detected: DataFrame, text: str, window: int) -> DataFrame:
    """(text_key, entity, terms, counted, covered): one row per base span; terms are the words around it.

    The `window` nearest words of the whole text on either side; words inside a base span are passed over.
    `counted` has every word near the entity once in all rows of a text together; `covered`, in one row
    of a text, all words inside its base spans.
    """
    body = F.col(f"`{text}`")

    def of(kind: Kind) -> Column:
        entity = lambda r: F.concat(F.lit(kind.name + ":"), kind.entity(r["match"]))
        return F.transform(f"__{kind.name}", lambda r: F.struct(entity(r).alias("entity"), r["start"].alias("start"), r["end"].alias("end")))

    def rows(spans: Column, words: Column, starts: Column, ends: Column) -> Column:
        def inside(r: Column) -> Column:
            first, last = _before(starts, r["start"]), _before(ends, r["end"] + 1) - 1
            return _bind(F.struct(first.alias("first"), last.alias("last")), lambda x: F.when(x["first"] <= x["last"], F.sequence(x["first"], x["last"])).otherwise(F.array().cast("array<int>")))

        def around(words: Column, starts: Column, covered: Column) -> Column:
            at = F.sort_array(F.transform(spans, lambda r: F.struct(r["entity"].alias("entity"), _before(starts, r["start"]).alias("p"))))

            def near(r: Column, low: Column) -> Column:
                return F.slice(words, low + 1, r["p"] + window - low)

            def row(at: Column, r: Column, i: Column) -> Column:
                low = F.greatest(r["p"] - window, F.lit(0))
                last = F.get(at, i - 1)  # the span of the same entity before this one, if any
                free = F.when(last["entity"] == r["entity"], F.greatest(low, last["p"] + window)).otherwise(low)
                return F.struct(
                    r["entity"].alias("entity"), F.array_distinct(near(r, low)).alias("terms"), near(r, free).alias("counted"),
                    F.when(i == 0, covered).otherwise(F.array().cast(NO_TEXTS)).alias("covered"),
                )

            return _bind(at, lambda at: F.transform(at, lambda r, i: row(at, r, i)))

        def both(x: Column) -> Column:
            lower = lambda at: F.transform(at, lambda i: F.lower(words[i]))
            free = F.struct(lower(x["free"]).alias("words"), F.transform(x["free"], lambda i: starts[i]).alias("starts"), lower(x["covered"]).alias("covered"))
            return _bind(free, lambda y: around(y["words"], y["starts"], y["covered"]))

        covered = F.array_distinct(F.flatten(F.transform(spans, inside)))
        return _bind(covered, lambda c: _bind(F.struct(c.alias("covered"), F.array_except(F.sequence(F.lit(0), F.size(words) - 1), c).alias("free")), both))

    def placed(x: Column) -> Column:
        return _bind(_starts(x["gaps"], x["words"]), lambda starts: _bind(
            F.transform(x["words"], lambda w, i: starts[i] + F.length(w)), lambda ends: rows(x["spans"], x["words"], starts, ends)
        ))

    spans = F.concat(*map(of, KINDS))
    # Bound, not in columns of their own, which the optimizer would compute again for every element.
    parts = F.struct(spans.alias("spans"), F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"), F.split(body, WORD).alias("gaps"))
    found = F.when(F.size(spans) > 0, _bind(parts, placed))
    return detected.select(F.md5(body.cast("binary")).alias("text_key"), F.explode(found).alias("r")).select("text_key", "r.*")


def revealing_terms(
    contexts: DataFrame, texts: DataFrame, text: str, window: int = 8, support: int = 3, generalise_at: float = 0.8, remove_at: float = 0.95
) -> DataFrame:
    """(entity, term, disclosure, removed) over the corpus `texts`."""
    together = contexts.select("entity", F.explode("counted").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    entities = contexts.groupBy("entity").agg(F.count("*").alias("n_spans"), F.sum(F.size("counted")).alias("n_near")).filter(F.col("n_spans") >= support)
    # Lowered word by word: what a letter becomes may depend on its neighbours.
    words = texts.select(F.explode(F.split(F.col(f"`{text}`"), NO_WORD)).alias("word")).filter("word <> ''").select(F.lower("word").alias("term"), F.lit(1).alias("n"))
    covered = contexts.select(F.explode("covered").alias("term"), F.lit(-1).alias("n"))
    folder = shared_dir(texts.sparkSession, "term-counts")
    words.unionByName(covered).groupBy("term").agg(F.sum("n").alias("n_term")).filter("n_term > 0").write.parquet(folder)
    counted = texts.sparkSession.read.parquet(folder)
    n_words = counted.agg(F.sum("n_term")).first()[0] or 1
    rates = together.filter(F.col("n_both") >= support).join(entities, "entity").join(counted, "term").filter(F.col("n_near") < n_words)
    p_given, p_entity = F.col("n_both") / F.col("n_term"), F.col("n_near") / F.lit(n_words)
    share = F.log(p_given / p_entity) / -F.log(p_entity)
    scored = rates.select("entity", "term", share.alias("disclosure"))
    return scored.filter(F.col("disclosure") >= generalise_at).withColumn("removed", F.col("disclosure") >= remove_at)


def sanitise(df: DataFrame, text: str = "text", window: int = 8, **limits) -> DataFrame:
    """`df` with n_email, n_ip, n_card, n_phone, `spans` (kind, start, end; base first) and `sanitised` text."""
    clash = {"spans", "sanitised", *(f"n_{k.name}" for k in KINDS)} & set(df.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    spark = df.sparkSession
    detected = detect(df, text)
    folder = shared_dir(spark, "entity-contexts")
    entity_contexts(detected, text, window).drop("terms").write.parquet(folder)
    contexts = spark.read.parquet(folder)
    revealing = revealing_terms(contexts, df.select(df[text]), text, window, **limits)
    folder = shared_dir(spark, "marked-terms")
    revealing.groupBy("term").agg(F.max("removed").alias("removed")).write.parquet(folder)
    marked = spark.read.parquet(folder)
    if marked.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES:  # then no word is shuffled
        marked = F.broadcast(marked)
    body = F.col(f"`{text}`")
    words = df.select(F.md5(body.cast("binary")).alias("text_key"), F.explode(F.array_distinct(F.split(body, NO_WORD))).alias("word"))
    telling = (
        words.select("text_key", F.lower("word").alias("term")).join(marked, "term")
        .groupBy("text_key", "term").agg(F.max("removed").alias("removed"))
        .groupBy("text_key").agg(F.collect_list(F.struct("term", "removed")).alias("__telling"))
    )
    folder = shared_dir(spark, "revealing-terms")
    telling.write.parquet(folder)
    telling = spark.read.parquet(folder)
    weight = 128 + F.aggregate("__telling", F.lit(0), lambda a, t: a + F.octet_length(t["term"]) + 32)
    if telling.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] <= BROADCAST_BYTES:  # else all texts are shuffled once
        telling = F.broadcast(telling)
    own = [F.col(f"`{c}`") for c in df.columns]
    keyed = detected.withColumn("__spans", base_spans()).withColumn("__key", F.md5(F.col(f"`{text}`").cast("binary")))
    told = keyed.join(telling, F.col("__key") == F.col("text_key"), "left")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has = F.col("__telling").isNotNull()
    none = F.array().cast(NO_TEXTS)
    told = told.select(
        *own, "__spans", "__telling", *[F.size(f"__{k.name}").cast("long").alias(f"n_{k.name}") for k in KINDS],
        F.when(has, F.regexp_extract_all(body, F.lit(WORD), F.lit(0))).otherwise(none).alias("__words"),
        F.when(has, F.split(body, WORD)).otherwise(none).alias("__gaps"),
    )
    starts = _bind(_starts(F.col("__gaps"), F.col("__words")), lambda s: F.transform("__words", lambda w, i: F.struct(F.lower(w).alias("w"), s[i].alias("start"), (s[i] + F.length(w)).alias("end"))))
    names = F.transform("__telling", lambda t: t["term"])
    gone = F.transform(F.filter("__telling", lambda t: t["removed"]), lambda t: t["term"])

    def term_spans(told: Column, removed: Column) -> Column:
        picked = F.filter(starts, lambda r: F.array_contains(told, r["w"]) & ~F.exists("__spans", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
        return F.transform(picked, lambda r: F.struct(F.lit("term").alias("kind"), r["start"].alias("start"), r["end"].alias("end"), F.array_contains(removed, r["w"]).alias("removed")))

    empty = F.array().cast("array<struct<kind:string,start:int,end:int,removed:boolean>>")
    told = told.withColumn(
        "__terms", F.when(has & (F.size("__words") > 0), _bind(names, lambda told: _bind(gone, lambda removed: term_spans(told, removed)))).otherwise(empty)
    )
    whole = F.concat(F.transform("__spans", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"), F.lit(False).alias("removed"))), F.col("__terms"))
    told = told.withColumn("spans", whole)
    return told.select(
        *own, *[f"n_{k.name}" for k in KINDS],
        F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
        F.when(F.size("spans") > 0, _rewritten(body, F.col("spans"))).otherwise(F.col(f"`{text}`")).alias("sanitised"),
    )


def _rewritten(body: Column, spans: Column) -> Column:
    """The text with a label in place of each span; spans that overlap share one."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["removed"].alias("removed"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(NO_TEXTS).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.when(s["removed"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        new = F.concat(acc["out"], F.array(F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), label))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when((s["start"] >= acc["at"]), new).otherwise(acc["out"]).alias("out"),
        )

    def close(acc: Column) -> Column:
        return F.concat(F.array_join(acc["out"], ""), F.substring(body, acc["at"] + 1, F.length(body)))

    return F.aggregate(ordered, start, step, close)


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
