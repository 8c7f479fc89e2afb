"""Secret scans in built-in expressions: candidates, features, and a random forest against false positives.

Candidates are mixed runs of 12 or more key characters and the values of assignments to telling names, 4 or more signs
that are no blanks or quotes. Features: length,
share of digits, changes of character class, distinct characters, coverage by a dictionary of the corpus's own letter
triples, path signs, the word before and whether the value is assigned. The forest is grown level by level: one
aggregate counts labels by tree, node, feature and bin over a bounded sample of labelled findings, and the best splits
become one SQL expression, so that a scan is a single pass of code-generated expressions. Candidates and their features
are written once and read for teaching and judging.

Defined results: a null or empty text has no finding. Each occurrence is a finding, also repeated ones and those of
repeated rows. Without labelled findings of both kinds every candidate has the share of true labels as its score (0.5
without any label). A null doc_id is kept. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import Scratch, only

# Public formats of well-known keys, names that secrets are assigned to, and the candidate's shape.
KNOWN_FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9a-zA-Z]{24,}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
NAMES = r"(?i:passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private[_-]?key)"
#: An assignment to a telling name, its key quoted or not, and its value: signs other than blanks and quotes, without
#: punctuation that ends a phrase and without what `&`, `,` or `;` joins on as the next assignment.
TELLING = (
    r"""(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++["']?\s{0,2}[=:])"""
    rf"""(?=[A-Za-z0-9_-]*?{NAMES})[A-Za-z0-9_-]++["']?\s{{0,2}}[=:]{{1,2}}+>?+\s{{0,2}}"""
    r"""(?:(?i:bearer|basic|token)\s{1,2})?["']?"""
)
ASSIGNED = (
    r"""(?:[^\s"'&,;:.)\]}>]|[&,;:.)\]}>](?![,;:.)\]}>]*+(?:[\s"']|\z))(?!(?<=[&,;])[A-Za-z0-9_.-]{1,40}\s{0,2}[=:])){4,}+"""
)
LEAD = r"""[A-Za-z_][A-Za-z0-9_-]{2,30}\s{0,2}[=:]\s{0,2}["']?"""
CANDIDATE = (
    rf"(?:{TELLING}{ASSIGNED})|(?<![A-Za-z0-9+/_.-])(?:{LEAD}|(?=[A-Za-z+/_.-]*+[0-9]))[A-Za-z0-9+/_.-]{{12,}}+"
)
PLACEHOLDER = r"(?i)^(x+|0+|1234\w*|changeme\w*|example\w*|placeholder\w*|your[_-]?\w+|test\w*|dummy\w*|none|null|true|false)$"

#: Characters before a candidate that are looked at, triples in the dictionary, bins of a feature.
BEFORE = 40
TRIPLES = 400
BINS = 16
#: Bound on the labelled findings the forest is grown from, and its shape.
SAMPLE = 20_000
TREES = 9
DEPTH = 4
FEATURES = ("length", "digits", "upper", "changes", "distinct", "coverage", "path", "named", "assigned", "quoted")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, start, value, before, lead): runs with a digit and a letter, or values assigned to telling names. `start`
    counts code points from 0. Matches are found in order, so the text before each is cut off by its own end."""
    docs = only(docs, "doc_id", "text").where(F.col("text").rlike("[A-Za-z0-9+/_.-]{12}") | F.col("text").rlike(TELLING))
    whole = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    docs = docs.withColumn("whole", whole).withColumn("parts", F.split("text", CANDIDATE, -1))
    lengths = F.transform("whole", lambda w: F.length(w))
    gaps = F.transform("parts", lambda p: F.length(p))
    docs = docs.withColumn("lengths", lengths).withColumn("gaps", gaps)
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    ends = F.aggregate(
        F.sequence(F.lit(1), F.size("whole")),
        nothing,
        lambda x, i: F.struct(
            (x["at"] + F.element_at("gaps", i) + F.element_at("lengths", i)).alias("at"),
            F.concat(x["all"], F.array(x["at"] + F.element_at("gaps", i) + F.element_at("lengths", i))).alias("all"),
        ),
    )["all"]
    docs = docs.where(F.size("whole") > 0).withColumn("ends", ends)
    found = docs.select("doc_id", "text", F.explode(F.arrays_zip("whole", "ends")).alias("x"))
    lead = F.regexp_extract("x.whole", f"^(?:{TELLING}|{LEAD})", 0)
    found = found.withColumn("lead", lead)
    value = F.expr("substring(x.whole, length(lead) + 1)")
    found = found.select(
        "doc_id",
        "text",
        value.alias("value"),
        "lead",
        (F.col("x.ends") - F.length(value)).alias("start"),
    )
    before = F.substring("text", F.greatest(F.lit(1), F.col("start") + 1 - BEFORE), F.least(F.lit(BEFORE), F.col("start")))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    return found.where(mixed | ((F.col("lead") != "") & F.col("lead").rlike(NAMES))).select(
        "doc_id", "start", "value", "lead", before.alias("before")
    )


def common_triples(docs: DataFrame, most: int = TRIPLES) -> list[str]:
    """The most frequent letter triples of all documents: the dictionary that ordinary words are made of."""
    plain = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+", " ")
    words = only(docs, "text").select(F.explode(F.split(plain, " ")).alias("word")).where("length(word) >= 3")
    words = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    at = F.sequence(F.lit(1), F.length("word") - 2)
    triples = words.select("n", F.explode(F.transform(at, lambda i: F.substring("word", i, F.lit(3)))).alias("triple"))
    top = triples.groupBy("triple").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "triple").limit(most)
    return [r["triple"] for r in top.collect()]


def with_features(found: DataFrame, triples: list[str]) -> DataFrame:
    """Adds a column f_<name>, 0 to 1, for each of FEATURES."""
    value, n = F.col("value"), F.length("value")
    kept = lambda pattern: F.length(F.regexp_replace(value, pattern, ""))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    lower = F.regexp_replace(F.lower("value"), "[^a-z]+", " ")
    own = F.regexp_extract_all(lower, F.lit("(?=([a-z]{3}))"), F.lit(1))
    common = F.array(*[F.lit(t) for t in triples]) if triples else F.array().cast("array<string>")
    covered = F.size(F.filter(own, lambda t: F.array_contains(common, t))) * 3
    columns = {
        "length": F.least(n, F.lit(64)) / 64,
        "digits": kept("[^0-9]") / n,
        "upper": kept("[^A-Z]") / n,
        "changes": (F.length(runs) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(40)),
        "coverage": F.least(F.lit(1.0), covered / n),
        "path": F.least(F.lit(1.0), kept("[^/.]") / 4),
        "named": (F.col("lead").rlike(NAMES) | F.col("before").rlike(NAMES + r"\W{0,4}$")).cast("double"),
        "assigned": (F.col("lead") != "").cast("double"),
        "quoted": F.concat("before", "lead").rlike("[\"']$").cast("double"),
    }
    return found.withColumns({f"f_{k}": F.coalesce(F.least(F.lit(1.0), c.cast("double")), F.lit(0.0)) for k, c in columns.items()})


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt: 1 for public key formats and for random values assigned to a telling
    name, 0 for placeholders, paths, host names, numbers with units and runs of ordinary words; others have none."""
    value = F.col("value")
    named = F.col("lead").rlike(NAMES)
    random = (F.length("value") >= 12) & value.rlike("[0-9].*[0-9].*[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(r"[/.]")
    ordinary = value.rlike(r"^[A-Za-z]*[0-9]{1,4}[A-Za-z]*$") | value.rlike(r"^[A-Za-z]+([-_.][A-Za-z0-9]+)+$") | value.rlike(r"^[0-9.+-]+$")
    label = F.when(value.rlike(KNOWN_FORMATS), 1).when(value.rlike(PLACEHOLDER), 0).when(named & random, 1)
    return found.withColumn("label", label.when(~named & (ordinary | value.rlike("/.*/") | value.rlike(r"^[\w-]+(\.[\w-]+)+$")), 0))


@dataclass
class Node:
    """A leaf has a share of true labels; an inner node a feature and a bin that parts it."""

    share: float
    feature: str | None = None
    bin: int = 0
    sides: list[Node] = field(default_factory=list)

    def expression(self) -> Column:
        if not self.sides:
            return F.lit(self.share)
        low = F.col(f"f_{self.feature}") * BINS < self.bin
        return F.when(low, self.sides[0].expression()).otherwise(self.sides[1].expression())


def _impurity(no: float, yes: float) -> float:
    return 2 * no * yes / (no + yes) if no + yes else 0.0


def forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> list[Node]:
    """Trees grown on (f_*, label): each on its own two thirds of the rows, each node over its own features."""
    scratch = Scratch(labelled.sparkSession)
    labelled = labelled.where("label is not null")
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return [Node(float(next(iter(sizes)))) if sizes else Node(0.5)]
    draw = F.xxhash64("value", "before", "start")
    share = F.when(F.col("label") == 1, F.lit(SAMPLE / 2 / sizes[1])).otherwise(F.lit(SAMPLE / 2 / sizes[0]))
    chosen = labelled.where(F.pmod(draw, F.lit(1 << 30)) < share * (1 << 30))
    bins = F.array(*[F.least(F.lit(BINS - 1), (F.col(f"f_{k}") * BINS).cast("int")) for k in FEATURES])
    sample = scratch.put(chosen.select("label", bins.alias("bins"), draw.alias("draw")), "labelled")
    ours = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.xxhash64("draw", t), F.lit(3)) != 0
    )
    grown = [Node(sizes[1] / (sizes[0] + sizes[1])) for _ in range(trees)]
    open_: dict[tuple[int, int], Node] = {(t, 1): n for t, n in enumerate(grown)}
    rows = sample.withColumn("tree", F.explode(ours)).withColumn("node", F.lit(1))
    for _ in range(depth):
        counted = rows.select("tree", "node", "label", F.posexplode("bins").alias("feature", "bin"))
        counts: dict = {}
        for r in counted.groupBy("tree", "node", "feature", "bin", "label").count().collect():
            held = counts.setdefault((r["tree"], r["node"]), {}).setdefault(r["feature"], [[0, 0] for _ in range(BINS)])
            held[r["bin"]][r["label"]] += r["count"]
        after, moves = {}, F.lit(0)
        for (tree, number), node in open_.items():
            best = None
            for feature, held in counts.get((tree, number), {}).items():
                if (feature * 7 + number * 3 + tree) % 3 == 0:
                    continue
                no, yes = (sum(h[i] for h in held) for i in (0, 1))
                low = [0, 0]
                for b in range(1, BINS):
                    low = [low[0] + held[b - 1][0], low[1] + held[b - 1][1]]
                    gain = _impurity(no, yes) - _impurity(*low) - _impurity(no - low[0], yes - low[1])
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, feature, b, low, [no - low[0], yes - low[1]])
            if best and best[0] > 1e-6:
                _, feature, b, *sides = best
                node.feature, node.bin = FEATURES[feature], b
                node.sides = [Node((s[1] + 0.5) / (sum(s) + 1)) for s in sides]
                after |= {(tree, 2 * number): node.sides[0], (tree, 2 * number + 1): node.sides[1]}
                at = (F.col("tree") == tree) & (F.col("node") == number)
                side = F.when(F.element_at("bins", feature + 1) < b, 2 * number).otherwise(2 * number + 1)
                moves = F.when(at, side).otherwise(moves)
        open_ = after
        if not open_:
            break
        rows = rows.withColumn("node", moves).where("node > 0")
    return grown


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Findings of `docs` (doc_id, text): doc_id, start, length, value_sha256, label, score, is_secret. `labelled` holds
    candidates with a label; without it those that `weak_labels` is sure of teach the forest, which then judges all."""
    triples = common_triples(docs)
    found = Scratch(docs.sparkSession).put(with_features(candidates(docs), triples), "candidates")
    grown = forest(weak_labels(found) if labelled is None else with_features(labelled, triples))
    score = sum((t.expression() for t in grown), F.lit(0.0)) / len(grown)
    return found.select(
        "doc_id",
        "start",
        F.length("value").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        score.alias("score"),
        (score >= 0.5).alias("is_secret"),
    )
