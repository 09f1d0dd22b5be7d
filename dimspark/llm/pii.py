"""Personal data by bootstrapped contextual extraction (operator 1).

Base matches have a form that speaks for itself: email, ip, card and phone. They
are the seeds of a search for identifiers that have no such form. Every run of
tokens that looks like an identifier at all is an instance; of a run that is longer
than a few tokens, or holds a base match beside others, or a label glued to a value,
all parts of up to ``WIDEST`` tokens are. The words around an instance are its
patterns. Instances and patterns make a graph. A pattern of a kind scores by
the share of its distinct instances that are of the kind, an instance by how many
scoring patterns hold it (noisy or); a few rounds carry scores through the graph.
Instances without a base match that have the form of the kind are what a pattern is to
find: once ``PROOF`` seeds speak for it, none of them counts against it. A reported
part of a long run grows by the tokens behind it as far as it keeps the kind's form.
Instances without a base form that end with a high score are reported, as spans,
wherever a confident pattern holds them.

Everything is DataFrame code. The graph is a narrow table of distinct pattern and
instance pairs, aggregated in the tasks first; documents never move, and the lists
of one document stay in its row.

Defined results: a NULL or empty text has no matches; NULL ids are kept; repeated
rows get a row each, but count once in the graph, where only distinct pairs do;
without seeds nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.text import whole_text
from dimspark.sources.shared import store

KINDS = ["email", "ip", "card", "phone"]

# The contract's forms. They begin where the last match ended or a run begins, and
# never go back into a run, so that the work follows the length of a text; the
# matches are the same.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text with a match certainly contains; most texts need no further look.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

_GAP = r"\x20\x09-\x0D"
_TOKEN = rf"[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+"
RUN = rf"(?<![^{_GAP}]){_TOKEN}(?:\x20{_TOKEN})*+"
LABEL = r"^[A-Za-z_-]{2,}[:=](?=.)"  # glued to the value that it names
WHOLE = 4  # tokens of a run that is an instance as it is
WIDEST = 8  # tokens of a part of a longer run that is an instance
GROWN = 19  # tokens to which a reported part may grow, as many as an identifier has digits

# Seeds of a pattern from which on unseen identifiers of the kind's form no longer count against it.
PROOF = 10

CONTEXT = 64  # code points on each side in which the neighbouring words are looked for


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Over up to 20 digits. Padded to 20, the digits at odd places (from 1) are those that double."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(F.lpad(digits, 20, "0"), i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), add) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """What a match must satisfy besides its form."""
    n = F.length(_digits(value))
    if kind == "ip":
        # A part above 255 has, without leading zeros, four digits or one of these forms.
        return ~value.rlike(r"(?<![0-9])0*+(?:[1-9][0-9]{3}|25[6-9]|2[6-9][0-9]|[3-9][0-9]{2})")
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def is_like(kind: str, value: Column) -> Column:
    """The loose form that an unseen identifier of a kind may have."""
    n = F.length(_digits(value))
    if kind == "email":
        return value.contains("@")
    if kind == "ip":
        return value.rlike(r"^[0-9A-Fa-f]{0,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$")
    if kind == "card":
        return n.between(12, 19) & value.rlike(r"^[0-9][0-9 ./-]*[0-9]$")
    return n.between(7, 15) & value.rlike(r"^[+(]?[0-9][0-9 ()./-]*[0-9]$")


def _with_running_sums(df: DataFrame, values: str, name: str) -> DataFrame:
    """``df`` with the running sums of an array.

    Sums run within blocks of about the root of the length, and over the blocks'
    sums, because an array grows by being copied. Each step is a column of its own
    that is read more than once, so that no step is computed again for each element.
    """
    n = F.size(values)
    root = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))

    def running(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))

        def add(state: Column, x: Column) -> Column:
            total = state["sum"] + x
            return F.struct(total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all"))

        return F.aggregate(xs, start, add, lambda state: state["all"])

    cut = F.transform(F.sequence(F.lit(0), F.ceil(n / root).cast("int") - 1), lambda i: F.slice(values, i * root + 1, root))
    blocks, sums = f"_{name}_blocks", f"_{name}_sums"
    df = df.withColumn(blocks, F.when(n > 0, F.transform(cut, running)).otherwise(F.array().cast("array<array<int>>")))
    df = df.withColumn(sums, running(F.transform(blocks, lambda block: F.element_at(block, -1))))
    lifted = F.transform(
        F.arrays_zip(F.col(blocks).alias("block"), F.col(sums).alias("sum")),
        lambda z: F.transform(z["block"], lambda x: x + z["sum"] - F.element_at(z["block"], -1)),
    )
    return df.withColumn(name, F.flatten(lifted)).drop(blocks, sums)


def with_matches(df: DataFrame, name: str, form: str, sign: Column, context: bool = False) -> DataFrame:
    """``df`` with an array of all matches in ``_text``: start, end, value, and the text around if asked.

    The pieces between the matches and the matches themselves alternate, so the
    running sums of their lengths are the ends of the matches, in code points.
    """
    gaps, found, steps, ends = (f"_{name}_{part}" for part in ("gaps", "found", "steps", "ends"))

    def gap(piece: Column) -> Column:
        parts = [F.length(piece).alias("n")]
        if context:
            parts += [F.right(piece, F.lit(CONTEXT)).alias("tail"), F.left(piece, F.lit(CONTEXT)).alias("head")]
        return F.struct(*parts)

    gap_type = "array<struct<n:int, tail:string, head:string>>" if context else "array<struct<n:int>>"
    df = df.withColumn(gaps, F.when(sign, F.transform(F.split("_text", form, -1), gap)).otherwise(F.array().cast(gap_type)))
    df = df.withColumn(
        found, F.when(sign, F.regexp_extract_all("_text", F.lit(form), F.lit(0))).otherwise(F.array().cast("array<string>"))
    )
    own = F.slice(gaps, 1, F.size(found))
    df = df.withColumn(steps, F.zip_with(own, F.col(found), lambda g, m: g["n"] + F.length(m)))
    df = _with_running_sums(df, steps, ends)
    parts = {"end": F.col(ends), "value": F.col(found)}
    if context:
        parts |= {"before": own["tail"], "after": F.slice(gaps, 2, F.size(found))["head"]}
    zipped = F.arrays_zip(*[column.alias(part) for part, column in parts.items()])

    def match(z: Column) -> Column:
        begin = (z["end"] - F.length(z["value"])).alias("start")
        return F.struct(begin, *[z[part].alias(part) for part in parts])

    return df.withColumn(name, F.transform(zipped, match)).drop(gaps, found, steps, ends)


def _valid(matches: str, kind: str) -> Column:
    return F.filter(matches, lambda m: is_valid(kind, m["value"]))


def _spans(matches: str, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.transform(
        matches,
        lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("kind"), m["end"].alias("end")),
    )


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ","
    )


def _matched(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts, ``_base`` spans and ``_runs``, one row for each row of ``docs``."""
    df = docs.select("doc_id", whole_text().alias("_text"))
    for kind in KINDS:
        sign = F.col("_text").contains(SIGNS[kind]) if kind == "email" else F.col("_text").rlike(SIGNS[kind])
        df = with_matches(df, f"_{kind}", FORMS[kind], sign)
        df = df.withColumn(f"_{kind}", _valid(f"_{kind}", kind))
    df = with_matches(df, "_runs", RUN, F.col("_text").rlike("[0-9@]"), context=True)
    counts = [F.size(f"_{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    base = F.concat(*[_spans(f"_{kind}", kind) for kind in KINDS])
    return df.select("doc_id", *counts, F.array_sort(base).alias("_base"), "_runs")


def _seed(value: Column, matches: Callable[[Column, Column], Column]) -> Column:
    """The first kind of which ``value`` has a valid match that ``matches``, as a place in ``KINDS``."""
    seed = F.lit(None).cast("int")
    for place, kind in reversed(list(enumerate(KINDS))):
        first = F.regexp_extract(value, FORMS[kind], 0)
        seed = F.when((first != "") & is_valid(kind, first) & matches(first, value), place).otherwise(seed)
    return seed


def _bare(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"^[^A-Za-z0-9+(@]+", ""), r"[^A-Za-z0-9)]+$", "")


def _parts(rows: DataFrame) -> DataFrame:
    """Runs as they are if they are short and no base match has company in them; others as all parts of a few tokens.

    ``counts`` marks one part for each token that parts begin with: scores of patterns count a place once.
    """
    run = rows.select("_n", F.explode("_runs").alias("r")).select("_n", "r.*")
    run = run.withColumn("tokens", F.split("value", " ")).withColumn("bare", _bare(F.col("value")))
    inside = _seed(F.col("bare"), lambda first, value: first != value)
    run = run.withColumn("whole", (F.size("tokens") <= WHOLE) & inside.isNull() & ~F.exists("tokens", lambda t: t.rlike(LABEL)))
    columns = ["_n", "start", "value", "before", "after"]
    whole = run.where("whole").select(*columns, F.lit(True).alias("counts"), F.array().cast("array<string>").alias("more"))
    split = _with_running_sums(run.where("NOT whole").withColumn("steps", F.transform("tokens", lambda t: F.length(t) + 1)), "steps", "ends")
    # Neighbours in the run, and the context of the run beyond its ends. Built before the run is dealt to rows, which
    # thus don't carry it.
    def near(i: Column) -> Column:
        own = F.array_join(F.slice("tokens", F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))), " ")
        left = F.size("tokens") - i
        return F.struct(
            F.when(i > 0, F.element_at("ends", F.greatest(i, F.lit(1)))).otherwise(0).alias("first"),
            F.when(i == 0, F.col("before")).when(i == 1, F.concat("before", own)).otherwise(own).alias("before"),
            F.when(left <= WIDEST, F.col("after")).otherwise("").alias("after"),
            left.alias("left"),
            F.slice("tokens", i + 1, GROWN + 1).alias("t"),
        )

    places = F.transform(F.sequence(F.lit(0), F.size("tokens") - 1), near)
    at = split.select("_n", "start", F.explode(places).alias("p")).select("_n", (F.col("start") + F.col("p.first")).alias("start"), "p.before", "p.after", "p.left", "p.t")
    at = at.withColumn("w", F.explode(F.sequence(F.lit(1), F.least("left", F.lit(WIDEST)))))
    value = F.array_join(F.slice("t", F.lit(1), F.col("w")), " ")
    after = F.when(F.col("w") < F.col("left"), F.concat(F.lit(" "), F.element_at("t", F.col("w") + 1))).otherwise(F.col("after"))
    # What the widest part may grow by when it is reported.
    more = F.when((F.col("w") == WIDEST) & (F.col("left") > WIDEST), F.slice("t", WIDEST + 1, GROWN - WIDEST))
    parts = at.select(
        "_n", "start", value.alias("value"), F.concat("before", F.lit(" ")).alias("before"), after.alias("after"), (F.col("w") == 1).alias("counts"),
        F.coalesce(more, F.array().cast("array<string>")).alias("more"),
    )
    # A label is a neighbour, unless the colons are an address's own.
    label = F.when(is_like("ip", F.col("value")), "").otherwise(F.regexp_extract("value", LABEL, 0))
    parts = parts.withColumn("label", label)
    n = F.length("label")
    return whole.unionByName(
        parts.select(
            "_n", (F.col("start") + n).alias("start"), F.expr("substring(value, length(label) + 1)").alias("value"),
            F.concat("before", "label").alias("before"), "after", "counts", "more",
        )
    )


def _instances(rows: DataFrame) -> DataFrame:
    """One row for each part: its place, its ``value`` without marks around it, its base kind, and its patterns."""
    lead = F.length(F.regexp_extract("value", r"^[^A-Za-z0-9+(@]*", 0))
    run = _parts(rows).select(
        "_n", (F.col("start") + lead).alias("start"), _bare(F.col("value")).alias("value"),
        F.lower("before").alias("l"), F.lower("after").alias("r"), "counts", "more",
    ).where(F.length("value") > 0)
    one = F.regexp_extract("l", rf"([^{_GAP}]++)[{_GAP}]*+$", 1)
    two = F.regexp_extract("l", rf"([^{_GAP}]++[{_GAP}]++[^{_GAP}]++)[{_GAP}]*+$", 1)
    right = F.regexp_extract("r", rf"^[{_GAP}]*+([^{_GAP}]++)", 1)
    patterns = F.array_compact(
        F.array(
            F.when(one != "", F.concat(F.lit("1 "), one)),
            F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, rf"[{_GAP}]+", " "))),
            F.when((one != "") & (right != ""), F.concat_ws(" ", F.lit("lr"), one, right)),
        )
    )
    run = run.withColumn("seed", _seed(F.col("value"), lambda first, value: first == value))
    # A part with more than a base match is none; the match is a part of its own, or lies across parts.
    run = run.where(F.col("seed").isNotNull() | _seed(F.col("value"), lambda first, value: F.lit(True)).isNull())
    end = (F.col("start") + F.length("value")).alias("end")
    return run.select(
        "_n", "start", end, "value", "seed", patterns.alias("patterns"), (F.col("counts") | F.col("seed").isNotNull()).alias("counts"), "more"
    )


def _grown_end(kind: Column) -> Column:
    """The end of a part with the tokens behind it, as many as leave it like its kind, so that none is reported in part."""

    def longer(n: Column) -> Column:
        return F.concat(F.col("value"), F.lit(" "), _bare(F.array_join(F.slice("more", F.lit(1), n), " ")))

    fitting = F.filter(F.sequence(F.lit(1), F.size("more")), lambda n: _any_like(kind, longer(n)))
    by = F.when(F.size("more") > 0, F.array_max(fitting))
    return F.when(by.isNull(), F.col("end")).otherwise(F.col("start") + F.length(longer(by)))


def _any_like(kind: Column, value: Column) -> Column:
    return reduce(lambda a, b: a | b, [(kind == place) & is_like(name, value) for place, name in enumerate(KINDS)])


def bootstrap(
    instances: DataFrame, rounds: int, least_support: int, pattern_score: float, instance_score: float
) -> tuple[DataFrame, DataFrame] | None:
    """Confident patterns (``pattern``, ``kind``, ``score``) and instances (``value``, ``kind``); None if there are none.

    Each round writes its scores, which are narrow, so a plan never holds more than
    one round.
    """
    edges = instances.select("value", "seed", "counts", F.explode("patterns").alias("pattern"))
    edges = store(edges.groupBy("value", "seed", "pattern").agg(F.max("counts").alias("counts")))
    seeds = edges.where("seed IS NOT NULL").select("value", F.col("seed").alias("kind")).distinct().withColumn("score", F.lit(1.0))
    counted = edges.where("counts")
    # Of each pattern: all instances, and for each kind those that have its form and no base match.
    unseen = [F.count_if(F.col("seed").isNull() & is_like(kind, F.col("value"))) for kind in KINDS]
    sizes = counted.groupBy("pattern").agg(F.count("*").alias("size"), F.array(*unseen).alias("unseen"))
    scores, patterns = seeds.withColumn("seeds", F.lit(1)), None
    for _ in range(rounds):
        mass = counted.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.sum("seeds").alias("seeds"), F.count("*").alias("held"))
        scored = mass.where(F.col("mass") >= least_support).join(sizes, "pattern")
        # Instances of another form or kind count against a pattern. Unseen ones of the form are what it is to
        # find: they count against it only while few seeds speak for it.
        alike = F.get("unseen", F.col("kind"))
        against = F.col("size") - F.col("seeds") - alike
        doubt = F.greatest(1 - F.col("seeds") / PROOF, F.lit(0.0)) * F.greatest(alike - (F.col("held") - F.col("seeds")), F.lit(0))
        share = F.col("mass") / (F.col("mass") + against + doubt + 1)
        patterns = store(scored.select("pattern", "kind", share.alias("score")).where(F.col("score") >= pattern_score))
        if patterns.isEmpty():
            return None
        open_edges = edges.where("seed IS NULL").join(patterns, "pattern").where(_any_like(F.col("kind"), F.col("value")))
        missed = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        found = store(open_edges.groupBy("value", "kind").agg((1 - missed).alias("score")))
        scores = seeds.withColumn("seeds", F.lit(1)).unionByName(found.withColumn("seeds", F.lit(0)))
    return patterns, found.where(F.col("score") >= instance_score).select("value", "kind")


def find_personal_data(
    docs: DataFrame,
    rounds: int = 3,
    least_support: int = 3,
    pattern_score: float = 0.6,
    instance_score: float = 0.8,
) -> DataFrame:
    """``doc_id``, the numbers of base matches, ``base_sha256``, ``spans`` and ``n_added`` of every document.

    ``spans`` are the base matches and the discovered identifiers.
    """
    rows = store(_matched(docs).withColumn("_n", F.monotonically_increasing_id()))
    instances = _instances(rows)
    learned = bootstrap(instances, rounds, least_support, pattern_score, instance_score)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if learned is None:
        found = rows.withColumn("_added", none)
    else:
        patterns, values = learned
        slots = instances.where("seed IS NULL").withColumn("pattern", F.explode("patterns"))
        spans = slots.join(patterns.select("pattern", "kind"), "pattern").join(values, ["value", "kind"])
        # Of parts that begin alike the widest is reported.
        widest = spans.groupBy("_n", "start", "kind").agg(F.max(_grown_end(F.col("kind"))).alias("end"))
        added = widest.groupBy("_n").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_more"))
        apart = F.filter("_more", lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
        found = rows.join(added, "_n", "left").withColumn("_added", F.coalesce(apart, none))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
        _written(F.concat("_base", "_added")).alias("spans"),
        F.size("_added").cast("bigint").alias("n_added"),
    )


