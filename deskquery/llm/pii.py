"""Personal data by candidate gradient boosting.

Generators propose spans: the base patterns, tighter patterns that also look
inside runs which a base pattern swallows whole (two card numbers with a space
between are one run that fails), and looser ones for phone numbers without a
plus and for emails with their signs spelled out. Candidates may overlap. Spans
that a base pattern accepts always stay.

The model decides on the rest. It learns how often candidates of like format
(digits, separators) in like context (characters beside the span, words before
and after it) are confirmed by evidence that it does not see: the check digit
of a card, the octets of an address, the plus of a phone number, the at sign of
an email. Its features are small whole numbers, so the corpus reduces to counts
per feature cell, and boosted trees of depth two are fitted to the counts of
one half of the rows. A candidate's worth is the chance that it is real. Where
evidence can be true by chance (one in ten numbers has the right check digit)
that is taken off, and the candidate itself must have it; where it can't, a
candidate without it may still be worth a redaction, if nearly all others like
it have it. Per kind a threshold is calibrated on the other half: the lowest
worth, ``FLOOR`` at least, above which ``PRECISION`` of the candidates are real.

Trees become SQL, and candidates are made, scored and chosen inside the
document's row: no shuffle, and nothing but the cells, bounded in number by the
features' ranges, leaves it. Folds over a text's spans go by blocks, so that
nothing is copied once per span and time is linear in the spans but for a term
of one part in ``_BLOCK``.

Cases: null and empty texts have no spans; texts of any length and any number
of spans work, in memory proportional to one text, and no pattern backtracks
more than linearly over a run; repeated rows give repeated rows; an empty table
fits a model that adds nothing; other columns pass through, whatever their
names. Offsets count code points; ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, let

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Runs are possessive and start only at their first character, which changes no match.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = (rf"(?:\x20{w}\x20|\x20?[\[(]\x20?{w}\x20?[\])]\x20?)" for w in ("at", "dot"))
_CARD_NEEDS, _DOT_NEEDS = r"[0-9](?:[\x20-]?[0-9]){11}", r"(?i)[\x20\[(]dot[\x20\])]"
#: Further generators: (kind, pattern, what a text must hold to be looked at: every match holds it).
MORE = (
    ("card", r"(?<![0-9])[0-9]{12,19}+(?![0-9])", "[0-9]{12}"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])", _CARD_NEEDS),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])", r"\+[0-9]"),
    ("phone", r"(?<![0-9+().-])(?<![0-9]\x20)(?:00[0-9]{1,3}[\x20.-])?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])", r"[0-9][\x20.-][0-9]{4}"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", r"[0-9]\.[0-9]"),
    ("email", rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+)+", _DOT_NEEDS),
)
#: The same for the base patterns.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": _CARD_NEEDS, "phone": r"\+[0-9]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: How often evidence is true by chance: check digits, and four numbers of up to three digits that are octets. Emails and phones have none that could be.
CHANCE = {"email": 0.0, "ip": 0.256**4, "card": 0.1, "phone": 0.0}
_WORDS = {1: "phone|call|tel|mobile|fax", 2: "card|visa|credit|pay", 3: "mail|contact|write", 4: "address|host|server|login"}
#: Feature ranges: values 0 to the number given.
FEATURES = {"kind": 3, "digits": 33, "groups": 9, "left": 3, "right": 3, "words": 4, "after": 4}
ROUNDS, RATE, PRECISION, FLOOR = 24, 0.5, 0.85, 0.8
_SPAN = "struct<kind:int,start:int,end:int,base:boolean,valid:boolean,digits:int,groups:int,left:int,right:int,words:int,after:int>"
_SLIM = "struct<start:int,kind:int,end:int,base:boolean>"
_BLOCK = 128


def scan(xs: Column, first: Column, state: str, out: str, step) -> Column:
    """A fold over a non-empty array that also gives entries out: step(state, x) is the next state and an array of entries.

    Returns s, the last state, and out. By blocks: entries are copied once in a block, and blocks as wholes."""
    types = f"struct<s:{state},out:array<{out}>>"

    def within(s: Column, block: Column) -> Column:
        def take(a: Column, x: Column) -> Column:
            after, new = step(a["s"], x)
            return F.struct(after.alias("s"), F.concat(a["out"], new).alias("out")).cast(types)

        return F.aggregate(block, F.struct(s.alias("s"), F.array().alias("out")).cast(types), take)

    def over(a: Column, block: Column) -> Column:
        return let(within(a["s"], block), lambda r: F.struct(r["s"].alias("s"), F.concat(a["out"], F.array(r["out"])).alias("out")))

    zero = F.struct(first.alias("s"), F.array().alias("out")).cast(f"struct<s:{state},out:array<array<{out}>>>")
    return let(xs, lambda found: F.aggregate(blocks(found), zero, over, lambda a: F.struct(a["s"].alias("s"), F.flatten(a["out"]).alias("out"))))


def blocks(xs: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _BLOCK).cast("int")), lambda b: F.slice(xs, b * _BLOCK + 1, F.lit(_BLOCK)))


def _class_of(c: Column) -> Column:
    """0 none or space, 1 letter, 2 digit, 3 other."""
    return F.when(c.isNull() | c.rlike(r"^\s?$"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).otherwise(3)


def _topic(near: Column) -> Column:
    found = F.lit(0)
    for value, pattern in _WORDS.items():
        found = F.when(near.rlike(rf"\b(?:{pattern})"), value).otherwise(found)
    return found


def _matches(text: Column, kind: str, pattern: str, needs: str, base: bool) -> Column:
    """The pattern's matches, leftmost first, with their features. Places come from the lengths of the pieces between matches."""
    k = KINDS.index(kind)

    def placed(both: Column) -> Column:
        lengths = F.transform(both["found"], lambda m, i: F.struct(F.char_length(F.get(both["gaps"], i)).alias("gap"), F.char_length(m).alias("n")))
        starts = scan(lengths, F.lit(0), "int", "int", lambda at, x: (at + x["gap"] + x["n"], F.array(at + x["gap"])))["out"]
        return let(starts, lambda starts: F.transform(both["found"], lambda m, i: described(m, F.get(starts, i), F.get(both["gaps"], i), F.get(both["gaps"], i + 1))))

    def described(m: Column, start: Column, before: Column, after: Column) -> Column:
        digits = F.regexp_replace(m, "[^0-9]+", "")
        n = F.char_length(digits)
        valid = {
            "email": m.contains("@"), "ip": m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "card": n.between(12, 19) & F.call_function("luhn_check", digits),
            "phone": m.startswith("+") & n.between(9, 15),
        }[kind]
        before, after = F.lower(F.right(before, F.lit(24))), F.lower(F.left(after, F.lit(24)))
        return F.struct(
            F.lit(k).alias("kind"), start.alias("start"), (start + F.char_length(m)).alias("end"), F.lit(base).alias("base"), valid.alias("valid"),
            F.least(n, F.lit(33)).alias("digits"), F.least(F.char_length(F.regexp_replace(m, r"[0-9+]+", "")), F.lit(9)).alias("groups"),
            _class_of(F.right(before, F.lit(1))).alias("left"), _class_of(F.left(after, F.lit(1))).alias("right"), _topic(before).alias("words"), _topic(after).alias("after"),
        )

    none = F.array().cast(f"array<{_SPAN}>")
    pieces = F.struct(F.split(text, pattern).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"))
    return F.when(text.rlike(needs), let(pieces, lambda both: F.when(F.size(both["found"]) > 0, placed(both).cast(f"array<{_SPAN}>")).otherwise(none))).otherwise(none)


def candidates(text: Column) -> Column:
    """All proposed spans of a text, those of the base patterns (base is true) first."""
    known = F.coalesce(text, F.lit(""))
    return F.concat(*[_matches(known, k, p, _NEEDS[k], True) for k, p in BASE.items()], *[_matches(known, *more, False) for more in MORE])


class Model:
    """Boosted trees of depth two, each (feature, cut, left, right) with a side either a leaf or (feature, cut, leaf, leaf)."""

    def __init__(self, start: float, trees: list, thresholds: list[float]):
        self.start, self.trees, self.thresholds = start, trees, thresholds

    def value(self, cell: dict) -> float:
        return self.start + sum(_walk(t, cell) for t in self.trees)

    def score(self, span: Column) -> Column:
        """The share of candidates like span that have their kind's evidence."""
        total = F.lit(self.start)
        for t in self.trees:
            total = total + _sql(t, span)
        return 1 / (1 + F.exp(-total))

    def worth(self, span: Column) -> Column:
        """The chance that span is real: see real."""
        chance = F.element_at(F.array(*[F.lit(CHANCE[k]) for k in KINDS]), span["kind"] + 1)
        return let(self.score(span), lambda p: F.when(chance == 0, p).when(span["valid"], (p - chance) / ((1 - chance) * p)).otherwise(0.0))

    def accepts(self, span: Column) -> Column:
        limit = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), span["kind"] + 1)
        return self.worth(span) >= limit if self.trees else F.lit(False)


def real(p: float, chance: float) -> float:
    """The share of real ones: of all where p have evidence that is never true by chance, or of those with evidence where it is true by chance."""
    return p if not chance else (p - chance) / ((1 - chance) * p) if p else 0.0


def _walk(t, cell: dict) -> float:
    while not isinstance(t, float):
        feature, cut, low, high = t
        t = low if cell[feature] <= cut else high
    return t


def _sql(t, span: Column) -> Column:
    if isinstance(t, float):
        return F.lit(t)
    feature, cut, low, high = t
    return F.when(span[feature] <= cut, _sql(low, span)).otherwise(_sql(high, span))


def fit(found: DataFrame) -> Model:
    """The model of a table with the column spans (see candidates). One aggregation; the driver gets one row per feature cell and half.

    Rows are halved by a hash of all their columns: trees learn from one half, thresholds from the other."""
    one = found.select(F.pmod(F.xxhash64(*[f"`{c}`" for c in found.columns]), F.lit(2)).cast("int").alias("half"), F.explode("spans").alias("s")).select("half", "s.*")
    rows = one.groupBy(*FEATURES, "half").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("valid").cast("long")).alias("y")).collect()
    cells = [r.asDict() for r in sorted(rows)]
    return boost([c for c in cells if not c["half"]], [c for c in cells if c["half"]])


def boost(cells: list[dict], held_out: list[dict] | None = None) -> Model:
    """Trees from cells (features, n candidates, y with evidence), thresholds from held_out, or from cells too where that is not given."""
    n, y = sum(c["n"] for c in cells), sum(c["y"] for c in cells)
    start = math.log((y + 1) / (n - y + 1))
    trees: list = []
    values = [start] * len(cells)
    for _ in range(ROUNDS if n else 0):
        slope = [(c, c["y"] - c["n"] * (p := 1 / (1 + math.exp(-v))), c["n"] * p * (1 - p)) for c, v in zip(cells, values, strict=True)]
        tree = _grow(slope, 2)
        trees.append(tree)
        values = [v + _walk(tree, c) for c, v in zip(cells, values, strict=True)]
    model = Model(start, trees, [])
    scored = [(1 / (1 + math.exp(-model.value(c))), c) for c in (cells if held_out is None else held_out)]
    model.thresholds = [_threshold([(real(p, CHANCE[kind]), c) for p, c in scored if c["kind"] == k], CHANCE[kind]) for k, kind in enumerate(KINDS)]
    return model


def _grow(slope: list[tuple], depth: int):
    g, h = sum(x[1] for x in slope), sum(x[2] for x in slope)
    leaf = RATE * g / (h + 1.0)
    best = (g * g / (h + 1.0) + 1e-9, None)
    if depth:
        for feature, most in FEATURES.items():
            sums = [[0.0, 0.0] for _ in range(most + 1)]
            for c, a, b in slope:
                sums[c[feature]][0] += a
                sums[c[feature]][1] += b
            lg = lh = 0.0
            for cut in range(most):
                lg, lh = lg + sums[cut][0], lh + sums[cut][1]
                gain = lg * lg / (lh + 1.0) + (g - lg) ** 2 / (h - lh + 1.0)
                if gain > best[0]:
                    best = (gain, (feature, cut))
    if best[1] is None:
        return leaf
    feature, cut = best[1]
    return (feature, cut, _grow([x for x in slope if x[0][feature] <= cut], depth - 1), _grow([x for x in slope if x[0][feature] > cut], depth - 1))


def _threshold(valued: list[tuple[float, dict]], chance: float) -> float:
    """The lowest worth, FLOOR at least, from which on PRECISION of the examples are real; 2 if there is none."""
    found, n, y = 2.0, 0, 0
    for worth in sorted({w for w, _ in valued if w >= FLOOR}, reverse=True):
        n += sum(c["n"] for w, c in valued if w == worth)
        y += sum(c["y"] for w, c in valued if w == worth)
        if real(y / n, chance) >= PRECISION:
            found = worth - 1e-9
    return found


def chosen(spans: Column, model: Model) -> Column:
    """Accepted spans (kind, start, end, base) by start, then kind: the base patterns' own, and the model's where no other lies."""
    slim = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))
    every = F.struct(
        F.sort_array(F.transform(F.filter(spans, lambda s: s["base"] & s["valid"]), slim)).alias("kept"),
        F.sort_array(F.transform(F.filter(spans, lambda s: ~(s["base"] & s["valid"]) & model.accepts(s)), slim)).alias("added"),
    )

    def merged(e: Column) -> Column:
        both = F.sort_array(F.concat(F.transform(e["kept"], lambda s: _marked(s, False)), F.transform(e["added"], lambda s: _marked(s, True))))
        return let(let(both, _apart), lambda free: F.when(F.size(free) > 0, F.sort_array(F.concat(e["kept"], _in_turn(free)))).otherwise(e["kept"]))

    none = F.array().cast(f"array<{_SLIM}>")
    return F.when(F.size(spans) == 0, none).otherwise(let(every, lambda e: F.when(F.size(e["added"]) > 0, merged(e)).otherwise(e["kept"])).cast(f"array<{_SLIM}>"))


def _marked(s: Column, new: bool) -> Column:
    return F.struct(s["start"].alias("start"), F.lit(new).alias("new"), s["end"].alias("end"), s.alias("span"))


def _apart(both: Column) -> Column:
    """Of the marked spans by start, the new ones that overlap none of the others: no other ends after their start, or starts before their end."""
    item = f"struct<start:int,new:boolean,end:int,span:{_SLIM}>"
    ahead = lambda last, x: (F.when(x["new"], last).otherwise(F.greatest(last, x["end"])), F.when(x["new"] & (x["start"] < last), F.array().cast(f"array<{item}>")).otherwise(F.array(x)))
    back = lambda next_, x: (F.when(x["new"], next_).otherwise(x["start"]), F.when(x["new"] & (x["end"] <= next_), F.array(x["span"])).otherwise(F.array().cast(f"array<{_SLIM}>")))
    left = scan(both, F.lit(0), "int", item, ahead)["out"]
    return let(left, lambda xs: F.when(F.size(xs) > 0, F.reverse(scan(F.reverse(xs), F.lit(2**31 - 1), "int", _SLIM, back)["out"])).otherwise(F.array().cast(f"array<{_SLIM}>")))


def _in_turn(free: Column) -> Column:
    """Spans by start, without those that overlap one taken before."""
    step = lambda last, s: (F.when(s["start"] >= last, s["end"]).otherwise(last), F.when(s["start"] >= last, F.array(s)).otherwise(F.array().cast(f"array<{_SLIM}>")))
    return scan(free, F.lit(0), "int", _SLIM, step)["out"]


def kind_name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in angle brackets. Where spans overlap the first covers the rest."""
    known = F.coalesce(text, F.lit(""))
    piece = "struct<at:int,to:int,kind:int>"

    def step(at: Column, s: Column):
        new = F.struct(at.alias("at"), s["start"].alias("to"), s["kind"].alias("kind"))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.array(new)).otherwise(F.array().cast(f"array<{piece}>"))

    def written(block: Column) -> Column:
        """The text before each span of a block, and the span's kind. The text is cut once a block, and that piece once a span."""
        first, last = block[0]["at"], F.element_at(block, -1)["to"]
        part = lambda here: F.transform(block, lambda p: F.concat(F.substring(here, p["at"] - first + 1, p["to"] - p["at"]), F.lit("<"), kind_name(p["kind"]), F.lit(">")))
        return F.array_join(let(F.substring(known, first + 1, last - first), part), "")

    built = lambda r: F.concat(F.array_join(F.transform(blocks(r["out"]), written), ""), F.substring(known, r["s"] + 1, F.char_length(known)))
    return F.when(F.size(spans) > 0, let(scan(spans, F.lit(0), "int", piece, step), built)).otherwise(text)


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with the personal data of the column text replaced. Without a model, one is fitted to docs."""
    rows = boxed(docs, F.col("text").cast("string").alias("text"))
    model = model or fit(rows.select("row", candidates(F.col("text")).alias("spans")).select(F.xxhash64("row").alias("row"), "spans"))
    text = let(chosen(candidates(F.col("text")), model), lambda spans: redact(F.col("text"), spans))
    return rows.select("row", text.alias("text")).select(*[(F.col("text") if c.lower() == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
