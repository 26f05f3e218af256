"""Personal data in texts: generators of candidate spans, boosted trees, calibrated thresholds.

Four base patterns with checks give spans that always count. Wider generators propose further
spans that may overlap. Boosted trees score those by format and context; they are taught by the
base candidates, which pass their checks or fail them, and by what announces a secret; they see
the checks, but not the announcement, so that they judge secrets by format. For each kind the
lowest score at which enough candidates are right, each judged by trees that it did not teach,
is the threshold. Where a kind has too few candidates for that, a span is added if its own check
passes; an announced secret is added always, whatever else the table holds.
Every candidate of the table teaches and calibrates, whatever their number.
All of it runs as DataFrame expressions and Spark's own trees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.fit_size import bound_partitions
from ..sources.scratch import write_once
from .texts import shuffled_place, whole

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
LEAST_SPANS = 50  # fewer teach nothing: checks alone decide
LEAST_JUDGED = 20  # of a kind, for a threshold of its own: else its check alone decides
TREES = 8
DEPTH = 3
PRECISION = 0.95  # share of candidates at or above a threshold that are right
FOLDS = 2
BY_CHECK = 0.5  # the score of a span that its check alone accepts
STEPS = 50  # of the score, among which thresholds are chosen
BEFORE, AFTER = 24, 4  # code points of context
SEED = 2

# Stand-ins with the same number of code points, so that positions stay what they are. With
# them every pattern is a sequence of character classes, which the regex engine reads in a loop
# and not by recursion, whatever the length of a text.
_DOT, _FOREIGN = "\ue000", "\ue001"
_LOCAL = rf"[A-Za-z0-9._%+{_DOT}-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]+"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9 -]*[0-9]"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
WIDE_CARD = r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])"
# A number that goes on to either side is no phone number.
WIDE_PHONE = (r"(?<![0-9+.-])(?<![0-9] )\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}"
              r"(?![0-9.-])(?! [0-9])")
SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+"
ANNOUNCED = r"(?i)(token|secret|passw|passwd|key|bearer|credential)[a-z_]{0,8}[\"' ]*[:= ][\"' ]*$"
_PART = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"

_SPAN = "array<struct<start: int, end: int, value: string>>"


def find_spans(text: Column, pattern: str) -> Column:
    """All matches, leftmost and without overlap, as ``(start, end, value)`` in code points."""
    pieces = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )

    def placed(found: Column) -> Column:
        first = F.struct(
            F.array().cast(_SPAN).alias("spans"), F.char_length(found["gaps"][0]).alias("at")
        )

        def add(state: Column, n: Column) -> Column:
            hit = found["hits"][n]
            end = state["at"] + F.char_length(hit)
            span = F.struct(state["at"].alias("start"), end.alias("end"), hit.alias("value"))
            return F.struct(
                F.concat(state["spans"], F.array(span)).alias("spans"),
                (end + F.char_length(found["gaps"][n + 1])).alias("at"),
            )

        count = F.size(found["hits"])
        steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.aggregate(steps, first, add, lambda state: state["spans"])

    # A list of one gives the two columns a name, so that each is computed once.
    return F.transform(F.array(pieces), placed)[0]


def _where(gate: Column, spans: Column) -> Column:
    return F.when(gate, spans).otherwise(F.array().cast(_SPAN))


def base_candidates(text: Column) -> dict[str, Column]:
    """The matches of the base patterns by kind, before their checks."""
    foreign = F.translate(text, _DOT, _FOREIGN)
    dotted = F.regexp_replace(foreign, r"\.(?![A-Za-z0-9-])", _DOT)
    # A blank or hyphen beside another one ends a card number: put a letter in its place.
    single = F.regexp_replace(text, r"(?<=[ -])[ -]|[ -](?=[ -])", "x")
    return {
        "email": _where(F.contains(text, F.lit("@")), find_spans(dotted, EMAIL)),
        "ip": _where(text.rlike(r"[0-9]\.[0-9]++\."), find_spans(text, IP)),
        "card": _where(
            text.rlike(r"[0-9](?:[ -]?[0-9]){15}"), find_spans(single, CARD)
        ),
        "phone": _where(text.rlike(r"\+[0-9]"), find_spans(text, PHONE)),
    }


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right is doubled."""
    size = F.char_length(digits)
    values = F.transform(
        F.sequence(F.lit(1), size),
        lambda n: F.substring(digits, n, F.lit(1)).cast("int") * (1 + (size - n) % 2),
    )
    total = F.aggregate(
        values, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d)
    )
    return total % 10 == 0


def passes_check(kind: Column, value: Column) -> Column:
    """Whether a candidate of a base kind is one: address parts, digits and check digit."""
    digits = _digits(value)
    size = F.char_length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", F.forall(F.split(value, r"\."), lambda p: p.rlike(_PART)))
        .when(kind == "card", F.when(size.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", size.between(8, 15))
        .otherwise(False)
    )


def _candidates(found: DataFrame) -> DataFrame:
    """One row for each proposed span with its context, whether it is a base span, and its
    label: whether it passes its check, or is announced as a secret."""
    rows = found.select("_row", F.explode("spans").alias("s")).select("_row", "s.*")
    good = F.coalesce(passes_check(F.col("kind"), F.col("value")), F.lit(False))
    announced = F.col("before").rlike(ANNOUNCED)
    return rows.withColumn("good", F.when(F.col("kind") == "secret", announced).otherwise(good))


def _features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    size = F.char_length(value)
    digits = _digits(value)
    count = F.char_length(digits)

    def share(pattern: str) -> Column:
        return (size - F.char_length(F.regexp_replace(value, pattern, ""))) / size

    wanted = {
        "f_size": size, "f_digits": share("[0-9]"), "f_lower": share("[a-z]"),
        "f_upper": share("[A-Z]"), "f_hex": share("[0-9a-fA-F]"), "f_marks": share("[^A-Za-z0-9]"),
        "f_groups": F.size(F.split(value, "[^A-Za-z0-9]+")),
        "f_kinds": F.size(F.array_distinct(F.split(value, ""))),
        "f_turns": F.regexp_count(value, F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]")),
        "f_long": F.char_length(F.regexp_extract(value, "^[A-Za-z0-9]*", 0)),
        "f_count": count, "f_first": F.try_to_number(F.substring(digits, 1, 1), F.lit("9")),
        "f_luhn": F.when(count.between(12, 19), _luhn(digits).cast("int")),
        "f_blank": before.rlike(r"(^|\s)$").cast("int"),
        "f_word": before.rlike("(?i)(tel|phone|call|mobile|mail|card|visa|account|ip|host)").cast(
            "int"),
        "f_digit_before": before.rlike("[0-9][ .-]?$").cast("int"),
        "f_closed": after.rlike("^[\"']").cast("int"), "f_ended": after.rlike(r"^(\s|$)").cast("int"),
        "f_digit_after": after.rlike("^[ .-]?[0-9]").cast("int"),
        **{f"f_is_{kind}": (F.col("kind") == kind).cast("int") for kind in KINDS},
    }
    numbers = {n: F.coalesce(c.cast("double"), F.lit(-1.0)) for n, c in wanted.items()}
    return rows.withColumns(numbers), list(wanted)


def _scored(found: DataFrame, extras: DataFrame) -> DataFrame:
    """The accepted ones of ``extras`` with their score: that of the trees taught by all of
    ``found``, or ``BY_CHECK`` where a check alone accepts them."""
    columns = ["_row", "kind", "start", "end", "score"]
    rows = _candidates(found)
    by_check = _candidates(extras).where("good").withColumn("score", F.lit(BY_CHECK)).select(columns)
    place = shuffled_place(SEED, "_row", "kind", "start", "end")
    taught, names = _features(rows.withColumn("_at", place % FOLDS))
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    taught = write_once(taught.select(
        *names, "kind", F.col("good").cast("double").alias("label"), "_at"), "taught")
    labels = taught.groupBy("_at").agg(
        F.countDistinct("label").alias("n"), F.count("*").alias("rows")).collect()
    if sum(r["rows"] for r in labels) < LEAST_SPANS:
        return by_check
    if len(labels) < FOLDS or min(r["n"] for r in labels) < 2:
        return by_check
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3)
    vectors = assembler.transform(bound_partitions(taught, len(names)))
    score = vector_to_array("probability")[1]
    step = F.floor(score * STEPS).cast("int")
    judged = [
        trees.fit(vectors.where(F.col("_at") != fold))
        .transform(vectors.where(F.col("_at") == fold))
        .select("kind", "label", step.alias("step"))
        for fold in range(FOLDS)
    ]
    accepted, told = F.col("good"), F.lit(BY_CHECK)
    for kind, lowest in _lowest_steps(reduce(DataFrame.union, judged)).items():
        enough = F.lit(False) if lowest is None else step >= lowest
        announced = F.col("good") & F.lit(kind == "secret")
        accepted = F.when(F.col("kind") == kind, enough | announced).otherwise(accepted)
        told = F.when((F.col("kind") == kind) & enough, score).otherwise(told)
    ready, _ = _features(_candidates(extras))
    scored = trees.fit(vectors).transform(assembler.transform(ready))
    return scored.where(accepted).withColumn("score", told).select(columns)


def _lowest_steps(judged: DataFrame) -> dict[str, int | None]:
    """For each kind with enough of ``(kind, label, step)`` the lowest step at and above which
    ``PRECISION`` of the labels are 1, or none if there is no such step."""
    bins = judged.groupBy("kind", "step").agg(
        F.count("*").alias("n"), F.sum("label").alias("right"))
    down = Window.partitionBy("kind").orderBy(F.col("step").desc())
    precise = F.sum("right").over(down) / F.sum("n").over(down) >= PRECISION
    found = bins.withColumn("at", F.when(precise, F.col("step"))).groupBy("kind").agg(
        F.sum("n").alias("n"), F.min("at").alias("at"))
    # One row for each kind at most.
    return {r["kind"]: r["at"] for r in found.collect() if r["n"] >= LEAST_JUDGED}


def _with_context(text: Column, kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["value"].alias("value"),
        F.substring(text, F.greatest(s["start"] - BEFORE, F.lit(0)) + 1,
                    F.least(s["start"], F.lit(BEFORE))).alias("before"),
        F.substring(text, s["end"] + 1, F.lit(AFTER)).alias("after"),
    ))


def find_personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, base, added)`` for every row: arrays of ``(kind, start, end)``, code points with
    the end exclusive. ``base`` are the matches of the base patterns that pass their checks, in
    order of kind and start; ``added`` are further spans that no base span and no better added
    one overlaps.

    A null text is empty and holds nothing. Rows that repeat get a row each; other columns are
    not read; an empty table gives an empty result. Among overlapping spans with equal scores the
    longest, then the first, stays. With few candidates, or only right or only wrong ones, spans
    are added whose own check passes; an announced secret is added in a table of any size.
    """
    body = F.col("_text")
    rows = df.select(F.col(key).alias("_key"), whole(text).alias("_text"))
    proposals = base_candidates(body)
    wide = {
        "card": _where(body.rlike("[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"),
                       find_spans(body, WIDE_CARD)),
        "phone": _where(body.rlike(r"[0-9]\)?[ .-][0-9]{3,4}[ .-][0-9]{3}"),
                        find_spans(body, WIDE_PHONE)),
        "secret": _where(body.rlike("[A-Za-z0-9_-]{20}"), find_spans(body, SECRET)),
    }
    mixed = F.filter(wide["secret"], lambda s: s["value"].rlike("[0-9]")
                     & s["value"].rlike("[A-Za-z]"))
    found = rows.select(
        "_key",
        F.concat(*[_with_context(body, k, s) for k, s in proposals.items()]).alias("spans"),
        F.concat(_with_context(body, "card", wide["card"]),
                 _with_context(body, "phone", wide["phone"]),
                 _with_context(body, "secret", mixed)).alias("wider"),
    )
    found = write_once(found.withColumn("_row", F.monotonically_increasing_id()), "candidates")
    base = F.transform(
        F.filter("spans", lambda s: F.coalesce(passes_check(s["kind"], s["value"]), F.lit(False))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                           s["end"].alias("end")),
    )
    marked = found.select("_key", "_row", base.alias("base"), "spans", "wider")
    free = F.filter("wider", lambda w: ~F.exists(
        "base", lambda b: (w["start"] < b["end"]) & (b["start"] < w["end"])))
    extras = marked.select("_row", free.alias("spans"))
    # What teaches: the base candidates, right or wrong, and the proposed secrets.
    secrets = F.filter("wider", lambda w: w["kind"] == "secret")
    teachers = marked.select("_row", F.concat("spans", secrets).alias("spans"))
    judged = _scored(teachers, extras)
    best_first = F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("rank"), (F.col("start") - F.col("end")).alias("size"),
        "start", "end", "kind")))
    chosen = judged.groupBy("_row").agg(best_first.alias("ranked")).select(
        "_row", F.aggregate(
            "ranked", F.array().cast("array<struct<kind: string, start: int, end: int>>"),
            lambda kept, s: F.when(
                F.exists(kept, lambda k: (s["start"] < k["end"]) & (k["start"] < s["end"])), kept
            ).otherwise(F.concat(kept, F.array(F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))),
        ).alias("added"),
    )
    return marked.join(write_once(chosen, "added"), "_row", "left").select(
        F.col("_key").alias(key), "base", F.coalesce("added", F.array()).alias("added")
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas in order of kind and start."""
    order = F.array(*[F.lit(k) for k in KINDS])
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("n"), s["start"].alias("start"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, none of which overlap, replaced by its kind in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    first = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        return F.struct(
            F.concat(state["done"], F.substring(text, state["at"] + 1, s["start"] - state["at"]),
                     F.lit("["), s["kind"], F.lit("]")).alias("done"),
            s["end"].alias("at"),
        )

    return F.aggregate(ordered, first, step, lambda state: F.concat(
        state["done"], F.substring(text, state["at"] + 1, F.char_length(text))))
