"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns and looser ones propose spans. Labelers vote on every span: the strict
pattern itself, a check of its form (Luhn, octets, digits), gazetteers (top-level domains,
networks, card issuers and calling codes, from a table or those listed here), the words before
it, and what touches it. Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is for each kind; a logistic classifier over votes and length is then
trained on the estimated labels and judges the looser spans. Spans of the strict patterns
that pass their form always stay.

The driver sees only the counts of distinct vote patterns, whose number is bounded by the
votes and kinds; texts are read twice and never moved.

Rows: a null text counts as empty; repeated rows are judged alike; texts are read whole,
with patterns that neither recurse nor look at a character more than a few times; without
any span no classifier is needed. Other columns stay; those named like a result are replaced.
"""

from __future__ import annotations

import ipaddress
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "form", "gazetteer", "context", "touching")
# Characters before a span that the context labeler reads.
CONTEXT = 40
ROUNDS = 100

# A private-use character that stands for a blank or hyphen between two digits, or for a dot
# between two characters of a domain; so that a chain of them is one run to the pattern.
_JOINT, _OTHER = "\uE000", "\uE001"
_LOCAL, _DOMAIN = f"[A-Za-z0-9._%+{_JOINT}-]", "[A-Za-z0-9-]"
# The strict patterns. A match cannot begin inside a run that its first part
# would have taken whole, unless the match before ended there (\G); so runs are read once.
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++{_JOINT}[A-Za-z0-9{_JOINT}-]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{_JOINT}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold before a strict pattern is tried.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
# Looser spellings, and what a text must hold before they are tried.
LOOSE = {
    "email": (r"[(\[]at[)\]]", r"(?<![\w.+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+"
              r"(?: ?[(\[]dot[)\]] ?[A-Za-z0-9-]{1,63}+){1,5}"),
    "ip": (r"[0-9A-Fa-f]:[0-9A-Fa-f]", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": (r"[0-9]{4}[._/][0-9]{4}", r"(?<![0-9])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    "phone": (r"[0-9]{3}[ .-][0-9]{4}", r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
}
# The entries of the gazetteers that are used where no table is given. Top-level domains
# besides the codes of countries; networks that are no single host's; beginnings of card
# numbers by issuer; calling codes of countries.
DOMAINS = "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel cat tel xxx post app dev blog online site tech store shop cloud uk eu su ac".split()
NETWORKS = ("0.0.0.0/8 10.0.0.0/8 100.64.0.0/10 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24 192.0.2.0/24 192.88.99.0/24 "
            "192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24 224.0.0.0/4 240.0.0.0/4").split()
ISSUERS = "4 34 37 36 38 39 300-305 309 3528-3589 50 51-55 56-58 2221-2720 6011 60 62 63 644-649 65 67 81 2200-2204 9792".split()
CALLING = ("1 7 20 27 30-34 36 39-41 43-49 51-58 60-66 81 82 84 86 90-95 98 211-213 216 218 220-269 290 291 297-299 350-359 370-389 "
           "420 421 423 500-509 590-599 670 672-692 800 808 850 852 853 855 856 870 878 880-883 886 888 960-968 970-977 979 992-998").split()
# Entries of a gazetteer table at most: they become part of the expressions.
MOST_ENTRIES = 20_000
# Words before a span that speak for its kind, and words that speak against any.
CUES = {
    "email": r"mail|contact|write|reach|kontakt|correo|courriel", "ip": r"\bip\b|host|server|address|ping|login",
    "card": r"card|visa|master|payment|credit|karte|tarjeta|carte", "phone": r"phone|call|tel|mobile|fax|cell|whatsapp|anruf",
}
AGAINST = r"version|\bv\.? ?$|isbn|issn|order|invoice|serial|section|chapter|build|release|\bid\b"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the check sum; for up to 19 of them."""
    figures = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: d.cast("int"))
    summed = F.aggregate(
        F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return summed % 10 == 0


def _form(kind: str, value: Column) -> Column:
    """The strict form of a span: what a match must pass besides its pattern."""
    n = F.length(_digits(value))
    if kind == "ip":
        octet = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _tail(value: Column) -> Column:
    """The end of a span, as long as a top-level domain needs."""
    return F.substring(value, -30, 30)


def _plausible(kind: str, value: Column) -> Column:
    """The form labeler: stricter than the form."""
    if kind == "email":
        return _tail(value).rlike(r"(?i)[.\]) ][a-z]{2,24}$")
    if kind == "ip":
        return ~value.rlike(r"(?:^|\.)0[0-9]")
    if kind == "card":
        return _luhn(value) & F.length(_digits(value)).between(13, 19)
    return F.length(_digits(value)).between(10, 13)


@dataclass(frozen=True)
class Gazetteer:
    """Known top-level domains, and ranges ``(digits, first, last)`` of what numbers begin with;
    networks are ranges of 32-bit numbers, and an address in one speaks against a person's."""

    domains: tuple[str, ...]
    networks: tuple[tuple[int, int], ...]
    issuers: tuple[tuple[int, int, int], ...]
    calling: tuple[tuple[int, int, int], ...]

    @staticmethod
    def of(entries: dict[str, list[str]]) -> Gazetteer:
        """From entries by kind: ``com``, ``10.0.0.0/8``, ``51`` or ``51-55``, ``1`` or ``211-213``."""
        def begins(kind: str) -> tuple:
            out = []
            for entry in entries.get(kind, []):
                first, _, last = entry.removeprefix("+").partition("-")
                out.append((len(first), int(first), int(last or first)))
            return tuple(sorted(out))

        networks = [ipaddress.ip_network(e) for e in entries.get("ip", [])]
        return Gazetteer(tuple(sorted({e.lower().lstrip(".") for e in entries.get("email", [])})),
                         tuple(sorted((int(n[0]), int(n[-1])) for n in networks if n.version == 4)), begins("card"), begins("phone"))

    def votes(self, kind: str, value: Column) -> Column:
        """1 or -1 for a listed span, else 0."""
        if kind == "email":
            ending = F.lower(F.regexp_extract(_tail(value), r"([A-Za-z0-9-]+)$", 1))
            return F.when(F.array_contains(F.array(*map(F.lit, self.domains)), ending), 1).otherwise(0) if self.domains else F.lit(0)
        if kind == "ip":
            parts = F.transform(F.split(value, r"\."), lambda p: p.try_cast("bigint"))
            number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + F.coalesce(p, F.lit(0)))
            inside = _any(number.between(a, b) for a, b in self.networks)
            return F.when((F.size(parts) == 4) & inside, -1).otherwise(0)
        ranges = self.issuers if kind == "card" else self.calling
        # a telephone number without its country's code begins with none of them
        known = _digits(value) if kind == "card" else F.when(F.startswith(value, F.lit("+")), _digits(value))
        return F.when(F.coalesce(_any(F.substring(known, 1, w).try_cast("int").between(a, b) & (F.length(known) >= w)
                                      for w, a, b in ranges), F.lit(False)), 1).otherwise(0)


def _any(tests) -> Column:
    tests = list(tests) or [F.lit(False)]
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]


def common_gazetteer(spark: SparkSession) -> Gazetteer:
    """The entries above; the domains of countries are the codes that the JVM lists."""
    countries = [str(c) for c in spark._jvm.java.util.Locale.getISOCountries()]
    return Gazetteer.of({"email": DOMAINS + countries, "ip": NETWORKS, "card": ISSUERS, "phone": CALLING})


def read_gazetteer(table: DataFrame) -> Gazetteer:
    """From a table ``(kind, entry)``; nulls and other kinds say nothing, and too long a table is an error."""
    rows = table.select("kind", F.trim("entry").alias("entry")).filter(F.col("kind").isin(*KINDS) & (F.length("entry") > 0)).distinct().limit(
        MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a gazetteer holds at most {MOST_ENTRIES} entries")
    return Gazetteer.of({k: [r.entry for r in rows if r.kind == k] for k in KINDS})


def _spans(kind: str, text: Column, subject: Column, pattern: str, strict: bool) -> Column:
    """All matches in order, as structs with code-point offsets into ``text``."""
    pieces, found = F.split(subject, pattern, -1), F.regexp_extract_all(subject, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int>>")
    sizes = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
    placed = F.aggregate(
        F.filter(sizes, lambda s: s["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"),
                                                    (acc["at"] + s["gap"] + s["size"]).alias("end")))).alias("spans")),
        lambda acc: acc["spans"])
    return F.transform(placed, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("value"), F.lit(strict).alias("strict")))


_SPAN = "array<struct<kind:string,start:int,end:int,value:string,strict:boolean>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _strict_spans(kind: str, text: Column) -> Column:
    plain, subject = F.translate(text, _JOINT, _OTHER), text
    if kind == "card":
        subject = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", _JOINT)
    if kind == "email":
        subject = F.regexp_replace(plain, rf"(?<={_DOMAIN})\.(?={_DOMAIN})", _JOINT)
    spans = F.filter(_spans(kind, text, subject, STRICT[kind], True), lambda s: _form(kind, s["value"]))
    return F.when(text.rlike(HINT[kind]), spans).otherwise(_none())


def _loose_spans(kind: str, text: Column) -> Column:
    hint, pattern = LOOSE[kind]
    return F.when(text.rlike(hint), _spans(kind, text, text, pattern, False)).otherwise(_none())


def propose(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base``, the strict spans, and ``more``, looser ones apart from them.

    Spans are structs (kind, start, end, value, strict) by kind, then start; offsets count
    code points and ends are exclusive.
    """
    whole = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    t = F.col("__text")
    found = whole.select(*[c for c in docs.columns if c not in ("base", "more")], "__text",
                         F.concat(*(_strict_spans(k, t) for k in KINDS)).alias("base"),
                         F.concat(*(_loose_spans(k, t) for k in KINDS)).alias("__loose"))
    apart = F.when(F.size("__loose") == 0, _none()).otherwise(F.filter("__loose", lambda s: ~F.exists(
        "base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))))
    return found.withColumn("more", apart).drop("__loose")


def _by_kind(kind: Column, of) -> Column:
    out = F.lit(0)
    for k in KINDS:
        out = F.when(kind == k, of(k)).otherwise(out)
    return out


def _votes(s: Column, text: Column, gazetteer: Gazetteer) -> list[Column]:
    """Votes of a span in the order of LABELERS (1, 0 or -1), and its length in four steps."""
    kind, value = s["kind"], s["value"]
    start = F.greatest(s["start"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, start + 1, s["start"] - start))
    sides = F.concat(F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise(""),
                     F.substring(text, s["end"] + 1, F.lit(1)))
    votes = [
        F.when(s["strict"], 1).otherwise(0),
        _by_kind(kind, lambda k: F.when(_plausible(k, value), 1).otherwise(-1)),
        _by_kind(kind, lambda k: gazetteer.votes(k, value)),
        F.when(before.rlike(AGAINST), -1).otherwise(
            _by_kind(kind, lambda k: F.when(before.rlike(CUES[k]), 1).otherwise(0))),
        F.when(sides.rlike(r"[\p{L}\p{N}]"), -1).otherwise(1),
    ]
    return [*(v.cast("int") for v in votes), F.least(F.lit(3), F.floor(F.length(value) / 8)).cast("int")]


def _voted(s: Column, text: Column, gazetteer: Gazetteer) -> Column:
    *votes, size = _votes(s, text, gazetteer)
    return F.struct(s["kind"].alias("kind"), *(v.alias(n) for n, v in zip(LABELERS, votes)), size.alias("size"))


@dataclass(frozen=True)
class Classifier:
    """Per kind: the weights of a constant, each labeler's vote, and each length step; and the
    gazetteer that the votes were made with."""

    weights: dict[str, list[float]]
    gazetteer: Gazetteer

    def chance(self, s: Column, text: Column) -> Column:
        *votes, size = _votes(s, text, self.gazetteer)

        def score(k: str) -> Column:
            w = self.weights[k]
            z = F.lit(w[0])
            for weight, vote in zip(w[1:], votes):
                z = z + F.lit(weight) * vote
            steps = F.array(*map(F.lit, w[1 + len(votes):]))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-(z + F.get(steps, size))))

        return _by_kind(s["kind"], score)


def estimate(patterns: list[tuple[str, tuple[int, ...], int, int]]) -> dict[tuple, float]:
    """Expectation-maximisation: the chance that each (kind, votes, size) pattern is personal data.

    Labelers vote independently given the truth, each with its own chances of every vote in
    either case; a little is added to all counts, and the start trusts the votes' sum.
    """
    out = {}
    for kind in KINDS:
        own = [(v, s, n) for k, v, s, n in patterns if k == kind]
        belief = [1 / (1 + math.exp(-1.5 * sum(v))) for v, _, _ in own]
        for _ in range(ROUNDS if own else 0):
            total = sum(n for _, _, n in own)
            prior = (sum(b * n for b, (_, _, n) in zip(belief, own)) + 1) / (total + 2)
            chances = []
            for j in range(len(LABELERS)):
                seen = {vote: [0.5, 0.5] for vote in (-1, 0, 1)}
                for b, (v, _, n) in zip(belief, own):
                    seen[v[j]][1] += b * n
                    seen[v[j]][0] += (1 - b) * n
                sums = [sum(x[c] for x in seen.values()) for c in (0, 1)]
                chances.append({vote: [x[c] / sums[c] for c in (0, 1)] for vote, x in seen.items()})
            new = []
            for v, _, _ in own:
                z = math.log(prior / (1 - prior)) + sum(
                    math.log(chances[j][vote][1] / chances[j][vote][0]) for j, vote in enumerate(v))
                new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            change = max(abs(a - b) for a, b in zip(new, belief))
            belief = new
            if change < 1e-6:
                break
        out.update({(kind, v, s): b for (v, s, _), b in zip(own, belief)})
    return out


def train(docs: DataFrame, text: str = "text", gazetteer: Gazetteer | None = None) -> Classifier:
    """Counts vote patterns over all documents, estimates their labels and fits the classifier."""
    gazetteer = gazetteer or common_gazetteer(docs.sparkSession)
    found = propose(docs.select(F.col(text).alias("text"))).filter(F.size("base") + F.size("more") > 0)
    votes = found.select(F.explode(F.transform(
        F.concat("base", "more"), lambda s: _voted(s, F.col("__text"), gazetteer))).alias("v"))
    counted = votes.groupBy("v").count().collect()
    patterns = [(r.v["kind"], tuple(r.v[n] for n in LABELERS), r.v["size"], r["count"]) for r in counted]
    belief = estimate(patterns)
    weights = {}
    for kind in KINDS:
        own = [([1.0, *map(float, v), *(float(s == i) for i in range(4))], belief[k, v, s], n)
               for k, v, s, n in patterns if k == kind]
        weights[kind] = _logistic(own)
    return Classifier(weights, gazetteer)


def _logistic(rows: list[tuple[list[float], float, int]], rounds: int = 500) -> list[float]:
    """Gradient steps on the counted patterns, shrunk a little; all zero but the constant if there are none."""
    w = [-1.0] + [0.0] * (len(LABELERS) + 4)
    total = sum(n for _, _, n in rows)
    for _ in range(rounds if total else 0):
        slope = [0.001 * x for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for i, value in enumerate(x):
                slope[i] += n / total * (p - y) * value
        w = [a - 1.0 * s for a, s in zip(w, slope)]
    return w


def find(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: the strict spans, and these with the looser ones
    that the classifier takes for personal data, by kind and start."""
    found = propose(docs, text)
    t = F.col("__text")
    taken = F.when(F.size("more") == 0, _none()).otherwise(
        F.filter("more", lambda s: classifier.chance(s, t) >= 0.5))
    place = F.array(*map(F.lit, KINDS))

    def order(a, b):
        x = F.array_position(place, a["kind"]) * F.lit(1 << 32) + a["start"]
        y = F.array_position(place, b["kind"]) * F.lit(1 << 32) + b["start"]
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    more = found.withColumn("__taken", taken)
    spans = F.when(F.size("__taken") == 0, F.col("base")).otherwise(
        F.array_sort(F.concat("base", "__taken"), order))
    kept = [c for c in docs.columns if c not in ("base", "spans")]
    return more.select(*kept, "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; a null stays null."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    steps = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(  # overlaps one that is masked already
            F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(F.struct(
                s["end"].alias("at"),
                F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                               F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))).alias("parts"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(steps)
