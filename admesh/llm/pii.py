"""Personal data found by patterns and by a weakly supervised span classifier.

Base spans follow fixed patterns and checks. Looser patterns give further
candidate spans: secrets, card numbers with a wrong checksum, phone numbers
without a country code, spelled-out addresses. Labellers vote on every candidate
(for, against, abstain): a format check, a gazetteer, cue words before the span,
what the span touches, and how varied it is. Expectation-maximisation over the
counts of vote patterns estimates how reliable each labeller is; the posteriors
train a logistic classifier on the votes and the kind, and it decides which
candidates join the base spans.

Everything on the rows is DataFrame expressions. The patterns are written so that
the regular expression engine neither backtracks over long runs nor recurses:
possessive repetition, and starts only where a run of its characters starts.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.tables import documents
from admesh.storage import RunFolder

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# An address starts where its run of characters starts, or where the last match ended.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
# Only whole runs of 16 to 19 digits with single blanks or dashes between them.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(]at[\])] ?{_LABEL}++(?:(?:\.| ?[\[(]dot[\])] ?){_LABEL}++)++",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+(?![A-Za-z0-9+/_-])",
}
VOTES = ("format", "gazetteer", "cue", "edge", "variety")
CUES = {
    "email": "mail|contact|write|address", "ip": r"\bip\b|host|server|addr|from", "card": "card|visa|master|pay|credit",
    "phone": r"call|tel|phone|fax|mobile|\+[0-9]", "secret": "token|key|secret|passw|pwd|auth",
}
TOP_LEVEL = "com|org|net|edu|gov|io|de|fr|es|uk|info|biz"
COUNTRY_CODES = r"1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[0-9]{2}|3[578][0-9]|42[01]"
BEFORE = 24  # code points searched for a cue
ACCEPT = 0.5

SPAN = "array<struct<kind:string,start:int,stop:int>>"


def _located(text: Column, pattern: str, keep) -> Column:
    """Matches of a pattern that pass ``keep``, leftmost without overlap, with their places.

    ``start, stop, match, head, follows``; ``head`` ends before the match and
    ``follows`` is the character after it. Both come from the pieces between
    the matches, which also give the places, so the work is linear in the text.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    fields = "start:int,stop:int,match:string,head:string,follows:string"
    none = F.array().cast(f"array<struct<{fields}>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("list"))

    def add(state, piece):
        start = state["at"] + F.length(piece["gap"])
        stop = start + F.length(piece["match"])
        one = F.struct(start.alias("start"), stop.alias("stop"), piece["match"].alias("match"),
                       F.right(piece["gap"], F.lit(BEFORE)).alias("head"),
                       F.substring(piece["next"], 1, 1).alias("follows"))
        return F.struct(stop.alias("at"), F.when(keep(piece["match"]), F.array_append(state["list"], one))
                        .otherwise(state["list"]).alias("list"))
    pieces = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match"),
                          F.slice(between, 2, F.size(found)).alias("next"))
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(pieces, begin, add)["list"]).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    figures = F.transform(F.split(F.reverse(_digits(match)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    summed = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(summed, F.lit(0), lambda a, b: a + b) % 10 == 0


def _small_parts(match: Column) -> Column:
    return ~F.rlike(match, F.lit(r"(?:^|\.)0*+(?:[1-9][0-9]{3}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])"))


def _phone_size(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


def _every(match: Column) -> Column:
    return F.lit(True)


def _candidates(text: Column) -> Column:
    """All candidates with ``base`` and the labellers' votes (1, 0, or -1 for an abstention)."""
    def described(kind, spans, base):
        def one(s):
            match, head, follows = s["match"], s["head"], s["follows"]
            plain = F.lower(head)

            def vote(yes, no=None):
                return F.when(yes, 1).when(F.lit(True) if no is None else no, 0).otherwise(-1).cast("tinyint")
            strict = base(match)
            form = {"secret": vote(F.rlike(match, F.lit("^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$")),
                                   ~F.rlike(match, F.lit("[0-9].*[0-9].*[0-9]")))}.get(kind, vote(strict))
            listed = {
                "email": vote(F.rlike(match, F.lit(rf"(?i)(?:\.|dot[\])] ?)(?:{TOP_LEVEL})$"))),
                "ip": vote(F.rlike(match, F.lit(r"^(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\."))),
                "card": vote(F.rlike(match, F.lit("^[3-6]"))),
                "phone": vote(F.rlike(match, F.lit(rf"^\+(?:{COUNTRY_CODES})(?![0-9]*\+)")), strict),
                "secret": vote(F.rlike(plain, F.lit(r"(?:token|key|secret|password|passwd|pwd)\W{0,6}$")), F.lit(False)),
            }[kind]
            cue = vote(F.rlike(plain, F.lit(CUES[kind])), F.lit(False))
            edge = vote(~(F.rlike(head, F.lit(r"[\p{L}\p{N}]$")) | F.rlike(follows, F.lit(r"[\p{L}\p{N}]"))))
            varied = vote(F.size(F.array_distinct(F.split(match, ""))) >= {"ip": 3, "phone": 5, "card": 5}.get(kind, 6))
            return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                            strict.alias("base"), form.alias("format"), listed.alias("gazetteer"), cue.alias("cue"),
                            edge.alias("edge"), varied.alias("variety"))
        return F.transform(spans, one)

    def no(match):
        return F.lit(False)
    # Strict and loose matches of a kind; a card's runs are all candidates, its checksum decides on the base.
    return F.concat(
        described("email", _located(text, EMAIL, _every), _every),
        described("ip", _located(text, IP, _small_parts), _every),
        described("card", _located(text, CARD, _every), luhn),
        described("phone", _located(text, PHONE, _phone_size), _every),
        *(described(kind, _located(text, pattern, _every), no) for kind, pattern in LOOSE.items()))


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 100):
    """EM over ``kind, votes, count``: posterior per pattern and each labeller's accuracies.

    Labellers are taken as independent given the class; every kind has its own
    share of true spans. It starts from the share of votes in favour.
    """
    def start(votes):
        cast = [v for v in votes if v >= 0]
        return (sum(cast) + 0.5) / (len(cast) + 1)
    posterior = [start(v) for _, v, _ in patterns]
    accuracy: list = []
    for _ in range(rounds):
        accuracy = []
        for labeller in range(len(VOTES)):
            table = {}
            for c in (0, 1):
                counts = {v: 0.5 for v in (1, 0, -1)}
                for (_, votes, n), p in zip(patterns, posterior):
                    counts[votes[labeller]] += n * (p if c else 1 - p)
                total = sum(counts.values())
                table[c] = {v: x / total for v, x in counts.items()}
            accuracy.append(table)
        share = {}
        for kind in KINDS:
            own = [(n, p) for (k, _, n), p in zip(patterns, posterior) if k == kind]
            share[kind] = (sum(n * p for n, p in own) + 0.5) / (sum(n for n, _ in own) + 1)
        posterior = []
        for kind, votes, _ in patterns:
            log = [math.log(share[kind] if c else 1 - share[kind]) + sum(
                math.log(accuracy[i][c][v]) for i, v in enumerate(votes)) for c in (0, 1)]
            posterior.append(1 / (1 + math.exp(min(500, max(-500, log[0] - log[1])))))
    return posterior, accuracy


def _features(kind: str, votes: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *(float(v == 1) - float(v == 0) for v in votes)]


def fit_classifier(patterns, posterior, rounds: int = 2000, rate: float = 0.5, decay: float = 0.001) -> list[float]:
    """Logistic weights on kind and votes, trained on the posteriors as soft labels."""
    weights = [0.0] * (1 + len(KINDS) + len(VOTES))
    rows = [(_features(k, v), n, p) for (k, v, n), p in zip(patterns, posterior)]
    total = sum(n for _, n, _ in rows) or 1
    for _ in range(rounds):
        slope = [decay * w for w in weights]
        for x, n, p in rows:
            error = n / total * (1 / (1 + math.exp(-sum(w * a for w, a in zip(weights, x)))) - p)
            for i, a in enumerate(x):
                slope[i] += error * a
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def _probability(span: Column, weights: list[float]) -> Column:
    score = F.lit(weights[0])
    for kind, w in zip(KINDS, weights[1:]):
        score = score + F.when(span["kind"] == kind, w).otherwise(0.0)
    for name, w in zip(VOTES, weights[1 + len(KINDS):]):
        score = score + F.when(span[name] == 1, w).when(span[name] == 0, -w).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def find_spans(docs: DataFrame, run: RunFolder, accept: float = ACCEPT) -> DataFrame:
    """``doc_id, base, spans`` of every row of ``doc_id, text``.

    Both are arrays of ``kind, start, stop`` (code points, end exclusive), by
    kind in the order of ``KINDS``, then start. ``base`` follows the patterns;
    ``spans`` adds the accepted candidates that overlap no base span. A null
    text is empty, every input row gives one row, other columns are ignored.
    The vote patterns that reach the driver are bounded by kinds and labellers,
    whatever the number of rows.
    """
    found = run.write(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .select("doc_id", _candidates(F.col("text")).alias("all")), "candidates")
    counted = (
        found.select(F.explode("all").alias("s")).groupBy("s.kind", *(f"s.{v}" for v in VOTES))
        .agg(F.count(F.lit(1)).alias("n")).orderBy("kind", *VOTES).collect())
    patterns = [(r.kind, tuple(r[v] for v in VOTES), r.n) for r in counted]
    posterior, _ = estimate(patterns)
    weights = fit_classifier(patterns, posterior)

    def ordered(spans):
        place = F.transform(spans, lambda s: F.struct(
            F.array_position(F.lit(list(KINDS)), s["kind"]).alias("order"), s["start"], s["stop"], s["kind"]))
        return F.transform(F.sort_array(place), lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    base = F.filter("all", lambda s: s["base"])
    more = F.filter("all", lambda s: ~s["base"] & (_probability(s, weights) > accept) & ~F.exists(
        base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    return found.select("doc_id", ordered(base).alias("base"), ordered(F.concat(base, more)).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, run: RunFolder) -> DataFrame:
    """``docs`` with each found span of ``text`` replaced by its kind in brackets, and ``n_chars`` renewed.

    Spans that overlap are replaced together, under the kind of the one that
    starts first, the longest of those. A null text stays null. Rows with a repeated or null id keep
    their own spans. All other columns are returned as they are, whatever their names.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    found = find_spans(docs.select(whole.alias("doc_id"), "text"), run).select(F.col("doc_id").alias("row"), "spans")
    text = F.col("row")["text"]
    by_start = F.transform(
        F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], -s["stop"], s["kind"]))),
        lambda s: F.struct(s["start"].alias("start"), (-s["col2"]).alias("stop"), s["kind"].alias("kind")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(state, s):
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        part = F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"),
                        F.when(s["start"] >= state["at"], F.array_append(state["parts"], part))
                        .otherwise(state["parts"]).alias("parts"))
    done = F.aggregate(by_start, begin, add, lambda state: F.concat(
        F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text))))
    renewed = {"text": F.col("done"), "n_chars": F.length("done").cast("bigint")}

    def value(name):
        own = F.col("row").getField(name)
        return (F.coalesce(renewed[name], own) if name in renewed else own).alias(name)
    return found.withColumn("done", F.when(F.size("spans") > 0, done)).select(*map(value, docs.columns))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    found = find_spans(documents(spark, folder), RunFolder(spark))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in KINDS[:4]),
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
