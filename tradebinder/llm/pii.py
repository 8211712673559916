"""Personal data in texts: rule matches, and looser candidates that boosted trees accept.

Built-in Spark expressions only; the driver sees counts per feature combination, never text.

Candidates of a kind come from two generators, the rule itself and a looser pattern that also
takes other notations (an e-mail with " at " and " dot ", a phone number without plus, with or
without brackets, a card number grouped by other marks, an address with blanks around its
dots); their spans may overlap.  The check of a kind (octets, check digit, number of digits, a
top domain of letters) labels the rule's own matches.  It is no feature: trees learn from format
and context (marks, lengths, the characters around, the word before) how often what looks like
this passes.  Looser candidates inside a match of another kind are negatives, too.

A looser span is added if it passes its check, its probability reaches the threshold of its kind,
and it overlaps no rule match that passed, nor one of its own kind that failed and is more than
a part of it.  The threshold is calibrated on feature combinations that the trees did not see:
what fails tells how much passes by chance.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import let, stored
from tradebinder.llm.trees import Forest, fit_forest

KINDS = ["email", "ip", "card", "phone"]

# The rules.  Repeats that nothing follows are possessive, so that long runs neither recurse
# nor backtrack; a look-behind starts a run at its first character or after the last match.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain for a kind to be looked for.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_AT, _DOT, _LABEL = r"(?:\x20?@\x20?|\x20?[\[(](?i:at)[\])]\x20?)", r"(?:\x20?[\[(](?i:dot)[\])]\x20?|\x20(?i:dot)\x20)", "[A-Za-z0-9-]{1,63}+"
LOOSE = {
    # A bare "at" must be followed by a name with a written dot.
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+(?:{_AT}{_LABEL}(?:\.|{_DOT})|\x20(?i:at)\x20{_LABEL}{_DOT}){_LABEL}(?:(?:\.|{_DOT}){_LABEL}){{0,7}}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][.\x20/-]{1,2})[0-9](?:[.\x20/-]{0,2}+[0-9]){11,18}+(?![.\x20/-]{0,2}[0-9])",
    "phone": r"(?<![0-9+])(?<![0-9+][\x20.-])(?:00\x20?[0-9]{1,3}+[\x20.-]?|[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,4}+\)\x20?|[0-9]{2,4}+[\x20.-])[0-9]{3,4}+[\x20.-][0-9]{3,4}+(?![\x20.-]?[0-9])",
}
# Words that announce a kind, and words that announce other numbers (fixed values).
CUES = {
    "email": "mail email contact write reply", "ip": "ip host server address node", "card": "card visa mastercard pay paid payment credit",
    "phone": "call phone tel telephone fax mobile dial",
}
OTHER_CUES = "ref reference order id no nr number invoice isbn version item part code serial"
FEATURES = ["kind", "digits", "breaks", "before", "after", "plus", "dots", "spaced", "length", "cue"]
CEILING = [4, 21, 8, 5, 5, 2, 6, 2, 6, 4]
# What passes a check by chance, to what fails it: one check digit in ten fits, one part of three
# digits in four is at most 255; where nothing is known, as much.
CHANCE = {"email": 1.0, "ip": 1 / 3, "card": 1 / 9, "phone": 1.0}
FOLDS = 5


def prefix_sums(values: Column, part: int = 256) -> Column:
    """Sum of all earlier values, per element, in two levels so that long arrays stay cheap."""

    def running(xs: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out"))
        return F.aggregate(xs, start, step)["out"]

    def split(v: Column) -> Column:
        starts = F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(part))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda s: F.slice(v, s, F.lit(part)))

    def joined(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x))
        each = F.zip_with(chunks, running(totals), lambda c, t: F.transform(running(c), lambda x: x + t))
        return F.flatten(each)

    return let(let(F.transform(values, lambda x: x.cast("long")), split), joined)


def spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, before, after, word) of all matches, in code points; word is the one before.

    The pieces between the matches and the matches add up to the text, so their lengths give
    the places.
    """
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(both: Column) -> Column:
        p, m = both["p"], both["m"]
        sizes = F.zip_with(F.slice(p, F.lit(1), F.size(m)), m, lambda a, b: F.length(a) + F.length(b))

        def each(ahead: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                start = F.get(ahead, i) + F.length(F.get(p, i))
                return F.struct(
                    start.alias("start"), (start + F.length(x)).alias("end"), x.alias("match"),
                    F.right(F.get(p, i), F.lit(1)).alias("before"), F.left(F.get(p, i + 1), F.lit(1)).alias("after"),
                    F.lower(F.regexp_extract(F.right(F.get(p, i), F.lit(24)), r"(\p{L}+)[^\p{L}]{0,3}$", 1)).alias("word"),
                )

            return F.transform(m, one)

        return let(prefix_sums(sizes), each)

    return let(F.struct(pieces.alias("p"), matches.alias("m")), placed)


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right every second digit counts double."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), weigh)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def rule_holds(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros do not count, so a part over 255 has four digits or is a number over 255.
        parts = F.transform(F.split(F.regexp_replace(match, "[^0-9.]", ""), r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.left(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return let(digits_of(match), lambda d: F.length(d).between(12, 19) & passes_luhn(F.left(d, F.lit(19))))
    return F.length(digits_of(match)).between(9, 15)


def looks_genuine(kind: str, match: Column) -> Column:
    """The check; of an e-mail, which the rule takes as it is, whether it ends in letters."""
    return match.rlike("[A-Za-z]{2}$") if kind == "email" else rule_holds(kind, match)


def _around(c: Column) -> Column:
    """0 nothing, 1 blank, 2 letter, 3 digit, 4 anything else."""
    return (
        F.when(c.isNull() | (c == ""), 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4)
    )


def features(kind: int, s: Column) -> Column:
    """Array of small integers, one per name in FEATURES, each below its CEILING."""
    m = s["match"]
    count = lambda cls: F.length(m) - F.length(F.regexp_replace(m, cls, ""))
    values = [
        F.lit(kind), F.least(count("[0-9]"), F.lit(20)), F.least(count(r"[\x20()/.-]"), F.lit(7)),
        _around(s["before"]), _around(s["after"]), F.when(m.startswith("+"), 1).otherwise(0),
        F.least(count(r"\."), F.lit(5)), F.when(m.rlike(r"[\x20\[(]"), 1).otherwise(0),
        F.least(F.floor(F.length(m) / 6), F.lit(5)), _cue(KINDS[kind], s["word"]),
    ]
    return F.array(*[v.cast("int") for v in values])


def _cue(kind: str, word: Column) -> Column:
    """0 a word that announces other numbers, 1 no word, 2 any other, 3 one that announces the kind."""
    return F.when(word.isin(OTHER_CUES.split()), 0).when(word == "", 1).when(word.isin(CUES[kind].split()), 3).otherwise(2)


def candidates(text: Column) -> Column:
    """Array of (kind, start, end, base, passed, genuine, features): rule matches, then looser ones.

    passed is the rule's verdict on its own matches, genuine the check of either.
    """
    found = [_candidates(text, n, base) for n in range(len(KINDS)) for base in (True, False)]
    return F.concat(*found)


def _candidates(text: Column, number: int, base: bool) -> Column:
    kind = KINDS[number]
    pattern = (RULES if base else LOOSE)[kind]

    def one(s: Column) -> Column:
        passed = rule_holds(kind, s["match"]) if base else F.lit(None).cast("boolean")
        return F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
            passed.alias("passed"), looks_genuine(kind, s["match"]).alias("genuine"), features(number, s).alias("features"),
        )

    # Texts without the rule's mark, or without any match, are not cut into pieces.
    hint = HINTS[kind] if base else None
    there = text.rlike(pattern) if hint is None else text.contains(hint) & text.rlike(pattern)
    return F.coalesce(F.when(there, F.transform(spans(text, pattern), one)), F.array().cast(_CANDIDATE))


_CANDIDATE = "array<struct<kind: int, start: bigint, end: bigint, base: boolean, passed: boolean, genuine: boolean, features: array<int>>>"


def labelled(found: Column) -> Column:
    """Array of (features, label): rule matches by their check, looser candidates that touch a match of another kind as negatives."""

    def lone(c: Column) -> Column:
        touches = lambda b: b["passed"] & (b["kind"] != c["kind"]) & (b["end"] > c["start"]) & (b["start"] < c["end"])
        return ~c["base"] & F.exists(found, lambda b: b["base"] & touches(b))

    row = lambda c, label: F.struct(c["features"].alias("features"), label.alias("label"))
    own = F.transform(F.filter(found, lambda c: c["base"]), lambda c: row(c, c["genuine"]))
    return F.concat(own, F.transform(F.filter(found, lone), lambda c: row(c, F.lit(False))))


def fit_trees(found: DataFrame) -> tuple[list[Forest], list[float]]:
    """Trees of each kind, and per kind the least probability down to which 95 of 100 that pass do so not by chance.

    The rows the driver gets are feature combinations with their counts in each of a few folds
    of the documents; there are at most as many as the product of the ceilings and in practice
    a few hundred.  The probabilities behind the limits come from trees that were fitted without
    the fold.  A kind of which no such limit exists accepts nothing.
    """
    each = found.select(F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), F.explode(labelled(F.col("found"))).alias("c"))
    rows = each.groupBy("c.features", "fold").agg(F.count_if("c.label").alias("yes"), F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: (r.features, r.fold))
    matrix = np.array([r.features for r in rows], float).reshape(len(rows), len(FEATURES))
    yes, n, fold = (np.array([r[c] for r in rows], float) for c in ("yes", "n", "fold"))
    label, weight = np.r_[np.ones(len(rows)), np.zeros(len(rows))], np.r_[yes, n - yes]
    own = weight > 0
    both = np.r_[matrix, matrix]

    def fitted(chosen: np.ndarray) -> Forest:
        return fit_forest(both[chosen], label[chosen], weight[chosen], trees=24, depth=3, rate=0.3, bins=24, least_weight=2)

    score, forests, thresholds = np.zeros(len(rows)), [], []
    for number, kind in enumerate(KINDS):
        mine = matrix[:, 0] == number
        train = own & np.r_[mine, mine]
        for k in range(FOLDS):
            if (held := mine & (fold == k)).any():
                score[held] = fitted(train & (np.r_[fold, fold] != k)).probability(matrix[held])
        forests.append(fitted(train))
        order = sorted(np.flatnonzero(matrix[:, 0] == number), key=lambda r: -score[r])
        limit, good, total = 1.01, 0.0, 0.0
        for r, below in zip(order, [*order[1:], None], strict=False):
            good, total = good + yes[r] - CHANCE[kind] * (n[r] - yes[r]), total + yes[r]
            if total and good >= 0.95 * total:
                # Half way to what no longer passes.
                limit = float(score[r] + (score[below] if below is not None else 0)) / 2
        # Never so low that what passes there is as likely chance as not.
        thresholds.append(max(limit, 2 * CHANCE[kind] / (1 + 2 * CHANCE[kind])))
    return forests, thresholds


def probability(forest: Forest, f: Column) -> Column:
    """A forest as one expression: a sum of nested conditions."""

    def node(at: int) -> Column:
        k = int(forest.feature[at])
        if k < 0:
            return F.lit(float(forest.value[at]))
        below = F.get(f, F.lit(k)) <= F.lit(float(forest.threshold[at]))
        return F.when(below, node(int(forest.left[at]))).otherwise(node(int(forest.right[at])))

    raw = reduce(lambda a, b: a + b, [node(int(r)) for r in forest.roots], F.lit(float(forest.base)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))


def detect(documents: DataFrame) -> DataFrame:
    """doc_id, text's spans (kind, start, end, base) of every row of ``documents`` (doc_id, text).

    The candidates of each whole text are found once and kept in the shared folder.  Spans are
    sorted by start, then kind; rule matches always stay, looser spans must reach the threshold
    of their kind and overlap no rule match that passed and none of their own kind that failed, parts of them aside.

    Null or empty text has no spans; a null doc_id stays null; repeated rows are returned each;
    empty input gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = stored(documents.select(F.col("doc_id").cast("long"), let(text, candidates).alias("found")))
    forests, thresholds = fit_trees(found)
    limits = F.array(*[F.lit(t) for t in thresholds])

    def of_kind(c: Column) -> Column:
        return F.coalesce(*[F.when(c["kind"] == n, probability(f, c["features"])) for n, f in enumerate(forests)])

    def chosen(every: Column) -> Column:
        rules, loose = F.filter(every, lambda c: c["base"]), F.filter(every, lambda c: ~c["base"])

        def pick(both: Column) -> Column:
            def accepted(c: Column) -> Column:
                def apart(b: Column) -> Column:
                    part = (b["start"] >= c["start"]) & (b["end"] <= c["end"]) & (b["end"] - b["start"] < c["end"] - c["start"])
                    counts = b["passed"] | ((b["kind"] == c["kind"]) & ~part)
                    return ~counts | (b["end"] <= c["start"]) | (b["start"] >= c["end"])

                return c["genuine"] & F.forall(both["b"], apart) & (of_kind(c) >= F.get(limits, c["kind"]))

            passed = F.filter(both["b"], lambda b: b["passed"])
            slim = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"))
            return F.array_sort(F.concat(F.transform(passed, slim), F.transform(F.filter(both["l"], accepted), slim)))

        return let(F.struct(rules.alias("b"), loose.alias("l")), pick)

    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint, base: boolean>>")
    return found.select("doc_id", F.when(F.size("found") > 0, let(F.col("found"), chosen)).otherwise(none).alias("spans"))


def written(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kind = lambda s: F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, found: Column, mark: str = "[{}]") -> Column:
    """The text with every span replaced by its kind; overlapping spans by the first of them."""
    marks = F.array(*[F.lit(mark.format(k)) for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        new = F.struct(F.concat(a["out"], gap, F.get(marks, s["kind"])).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= a["at"], new).otherwise(a)

    rest = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(found, start, step, rest)


def report(documents: DataFrame) -> DataFrame:
    """doc_id, base matches per kind, base_sha256 and spans of every row (see ``detect``)."""
    found = detect(documents)
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [number(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
