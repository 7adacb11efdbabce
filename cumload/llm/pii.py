"""Personal data by weak supervision (operator 10), in DataFrame functions only.

Four kinds of span (email, ip, card, phone) follow fixed patterns. Further
kinds (secrets, bank accounts, national ids, persons, addresses) have
candidate strings of a wide form (runs of capitalised words, numbered phrases),
which regex, gazetteer and context labelers judge each on its own: they vote
or abstain, and a candidate that none calls personal stays. For each kind expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, and the posteriors train
the final span classifier, a naive Bayes model over a candidate's shape. What
reaches the driver are counts of vote and shape patterns, bounded by their
number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumload.functions import matches
from cumload.llm.common import checkpointed, fresh

# Each pattern finds what its plain form finds, leftmost and non-overlapping. Possessive loops and the
# look-behinds keep the search linear in texts without white space: a later start in a run of characters
# can only succeed where the run's start does, or right after the match before (\G).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: A string that may be a credential: long, of token characters, with a digit, at any length; further parts after
#: dots (JWT) belong to it, and of these the first may lack the digit. Each run of characters is tried at its start only.
CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9]|eyJ[A-Za-z_-]++\.[A-Za-z_-]*+[0-9])[A-Za-z0-9_+/-]{12,}+(?:\.(?!\+|[0-9]{12})[A-Za-z0-9_+/-]{6,}+)*+"
#: Candidates of the other added kinds: account numbers in groups, national ids of either form, two to four capitalised
#: words in a row (or one after a title), and such words beside a number of up to five digits.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
NATIONAL = r"(?<![0-9A-Za-z-])(?=[0-9XYZ][0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{8}-?[A-Z]|[XYZ]-?[0-9]{7}-?[A-Z])(?![0-9A-Za-z-])"
PERSON = r"(?=\p{Lu})(?<![\p{L}\p{M}'-])(?!(?:{leads})\x20)(?:(?:(?:{titles})\.?\x20)?\p{Lu}\p{Ll}++(?:[\x20-]\p{Lu}\p{Ll}++){1,3}|(?:{titles})\.?\x20\p{Lu}\p{Ll}++)"
ADDRESS = r"(?=[0-9])(?<![0-9A-Za-z.,])[0-9]{1,5}[A-Za-z]?(?:\x20\p{Lu}\p{Ll}++){1,4}|(?=\p{Lu})(?<![\p{L}-])\p{Lu}\p{Ll}++(?:\x20d[eu](?:\x20l[aos]s?)?|\x20d[ea][ls])?(?:\x20\p{Lu}\p{Ll}++){0,3},?\x20[0-9]{1,4}[A-Za-z]?(?![0-9A-Za-z])"
ADDED = ("secret", "iban", "national_id", "person", "address")
#: Characters of context kept before a candidate.
CONTEXT = 24

# Known prefixes of issued credentials, and names that introduce one.
PREFIXES = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghs_", "glpat-", "sk_live_", "sk-", "xoxb-", "xoxp-", "eyJ")
# Common given names, titles, kinds of street, and countries whose accounts have an IBAN.
GIVEN = tuple(
    "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew George Peter Kevin Edward Brian Henry Jack Oliver "
    "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Emma Olivia Sophie Alice Grace Emily Julia Helen Laura Anna Ruth Kate Lucy "
    "Maria María José Juan Carlos Antonio Carmen Ana Luis Miguel Javier Manuel Pedro Pablo Lucía Sofía Elena Isabel Pilar Rosa Diego Jorge Francisco Teresa "
    "Pierre Jean Marie Louis Claire Camille Luc Michel Nicolas Hans Klaus Jürgen Wolfgang Heike Ursula Greta Lars Ingrid Giulia Marco Luca Paolo "
    "Wei Li Ming Mei Hiroshi Yuki Kenji Sakura Min Ji Priya Raj Amit Anil Deepa Sanjay Fatima Aisha Ahmed Mohammed Muhammad Ali Hassan Omar Layla Yusuf Ibrahim "
    "Olga Ivan Natasha Dmitri Svetlana Katarzyna Piotr Agnieszka Kwame Amara Chidi Ngozi".split()
)
# Capitalised words before a name that are no part of it.
LEADS = ("Dear", "Hello", "Hi", "Hey", "Signed", "Contact", "From", "By", "Name", "Patient", "Customer", "Client", "And", "Meet", "Ask", "Call", "Estimado", "Estimada", "Cher", "Chère")
# Words that open or close capitalised runs other than names of persons, and words before numbers that are no house's.
NO_NAMES = tuple(
    "The This That These Those There Here In On At By For From With And But Or If When While Where What Who How Why New Old North South East West Great Saint San Los Las "
    "University Institute College School Company Corporation Foundation Committee Council Ministry Department Street Road Avenue City River Lake Mount Park Hotel Bank "
    "License Public General Software Version Inc Ltd Corp Monday Tuesday Wednesday Thursday Friday Saturday Sunday "
    "January February March April May June July August September October November December".split()
)
NO_STREETS = tuple("Chapter Figure Section Table Page Part Volume Version Article Number Level Act Law Day Year January February March April May June July August September October November December".split())
# Sample numbers that were published and belong to nobody.
SAMPLE_IDS = ("078-05-1120", "219-09-9999", "987-65-4320", "00000000T", "00000000-T", "11111111H", "99999999R")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Sr", "Sra", "Mme", "Mlle")
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Boulevard", "Blvd", "Drive", "Court", "Square")
VIAS = ("Calle", "Avenida", "Plaza", "Rue", "Avenue", "Place")
COUNTRIES = ("AD", "AT", "BE", "BG", "CH", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MC", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK", "SM")
NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth", "bearer", "credential", "key")


def found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match, before>> of a pattern's matches, in code points, end exclusive, with the characters before each."""
    return matches.found(text, pattern, CONTEXT)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(d == "", 0).otherwise(F.when(i % 2 == 0, d.try_cast("int")).otherwise(F.try_element_at(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), d.try_cast("int") + 1))))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")


def base_spans(text: Column) -> dict[str, Column]:
    """The valid spans of each fixed kind. Matches that fail their test are dropped, without another try."""
    part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    digit = text.rlike("[0-9]")
    email = F.when(text.contains("@"), found(text, EMAIL)).otherwise(_none())
    ip = F.when(digit & text.rlike(IP), F.filter(found(text, IP), lambda s: s["match"].rlike(rf"^{part}(?:\.{part}){{3}}$"))).otherwise(_none())
    card = F.when(digit & text.rlike(CARD), F.filter(found(text, CARD), lambda s: F.length(_digits(s["match"])).between(12, 19) & luhn(_digits(s["match"])))).otherwise(_none())
    phone = F.when(text.contains("+"), F.filter(found(text, PHONE), lambda s: F.length(_digits(s["match"])).between(9, 15))).otherwise(_none())
    return dict(zip(KINDS, (email, ip, card, phone), strict=True))


def mod97(account: Column) -> Column:
    """Whether an account number passes its check: letters as 10 to 35, the first four characters last, remainder 1."""
    bare = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    value = lambda c: F.ascii(c) - F.when(c.between("0", "9"), 48).otherwise(55)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97) == 1


def check_letter(number: Column) -> Column:
    """Whether the last letter of a Spanish id is that of its digits (X, Y and Z before them count 0 to 2)."""
    bare = F.translate(F.replace(number, F.lit("-"), F.lit("")), "XYZ", "012")
    digits = F.regexp_extract(F.substring(bare, 1, 8), "^[0-9]{8}$", 0)
    at = (F.when(digits != "", digits).try_cast("int") % 23 + 1).cast("int")
    return F.coalesce(F.substring(F.lit("TRWAGMYFPDXBNJZSQVHLCKE"), at, F.lit(1)) == F.right(number, F.lit(1)), F.lit(False))


def _votes(kind: str, match: Column, before: Column, token: Column) -> dict[str, Column]:
    """Each labeler's vote: 1 personal, 0 not, -1 none. ``match`` is the part of ``token`` that is judged."""
    word = lambda yes, no="(?!)": F.when(before.rlike(rf"(?i)(?:{yes})[\"' ]*[=:#.]?[\"' ]*$"), 1).when(before.rlike(rf"(?i)(?:{no})[ ]*$"), 0).otherwise(-1)
    never = F.lit(-1)
    if kind == "iban":
        return {"regex": mod97(match).cast("int"), "gazetteer": F.left(match, F.lit(2)).isin(*COUNTRIES).cast("int"), "context": word("iban|account|konto|cuenta|compte", "part|ref|order"), "spread": F.when(F.length(match) >= 15, never).otherwise(0)}
    if kind == "national_id":
        american = match.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
        return {"regex": (american | check_letter(match)).cast("int"), "gazetteer": F.when(match.isin(*SAMPLE_IDS), 0).otherwise(-1), "context": word(r"ssn|social security(?: number)?|dni|nif|nie|national id|identity|passport", "part|ref|order|isbn|model"), "spread": F.when(F.size(F.array_distinct(F.split(_digits(match), ""))) <= 2, 0).otherwise(-1)}
    if kind == "person":
        bare = F.regexp_replace(match, rf"^(?:{'|'.join(TITLES)})\.?\x20", "")
        first = F.regexp_extract(bare, r"^\p{L}+", 0)
        return {
            "regex": F.when(bare != match, 1).otherwise(-1),
            "gazetteer": F.when(first.isin(*GIVEN), 1).when(first.isin(*NO_NAMES) | F.regexp_extract(bare, r"\p{L}+$", 0).isin(*NO_NAMES), 0).otherwise(-1),
            "context": word(r"name is|name|contact|signed(?: by)?|dear|regards,?|sincerely,?|written by|from|patient|customer|client|i am|met|spoke (?:to|with)|called", r"saint|san|university of|city of|king|queen|pope|the|in|at|of|near"),
            "spread": F.when(before.rlike(r"(?:^|[.!?:\n]\s*)$"), 0).otherwise(-1),  # the first word of a sentence is capitalised anyway
        }
    if kind == "address":
        named = F.exists(F.split(match, r"[\x20,]+"), lambda w: w.isin(*STREETS, *VIAS))
        number = F.regexp_extract(match, "[0-9]+", 0)
        return {
            "regex": F.when(number.rlike("^(?:1[89]|20)[0-9]{2}$"), 0).otherwise(-1),  # a year
            "gazetteer": F.when(named, 1).when(F.exists(F.split(match, r"[\x20,]+"), lambda w: w.isin(*NO_STREETS)), 0).otherwise(-1),
            "context": word(r"lives? at|living at|address|at|deliver(?:ed)? to|ship(?:ped)? to|home|residence|domicilio|vive en", r"chapter|page|figure|top|the|on|in|of|version"),
            "spread": F.when(F.size(F.split(match, r"[\x20,]+")) <= 2, 0).otherwise(-1),
        }
    names, prefixes = "|".join(NAMES), "|".join(PREFIXES)
    distinct = F.size(F.array_distinct(F.split(match, "")))
    return {
        "regex": F.when(match.rlike(r"^(?:[0-9a-f]{16,}|[0-9A-F]{16,}|(?=.*[0-9].*[0-9])(?=.*[A-Z])[A-Z0-9]{20})$") | token.rlike(r"^eyJ[\w-]++\.eyJ[\w-]++\."), 1).when(match.rlike(r"^[A-Za-z]+-?[0-9]{1,4}$"), 0).otherwise(-1),
        "gazetteer": F.when(token.rlike(f"^(?:{prefixes})"), 1).otherwise(-1),
        "context": F.when(before.rlike(rf"(?i)(?:{names})[\"' ]*[=:]+[\"' ]*$"), 1).when(before.rlike(r"(?i)(?:page|id|ref|part|figure|no\.?|#|/)[ ]*$") | (before.endswith(".") & match.rlike("^[A-Za-z]{2,}/")), 0).otherwise(-1),
        "spread": F.when((distinct >= 9) & (F.length(_digits(match)) >= 4), 1).when(distinct <= 5, 0).otherwise(-1),
    }


def _shape(match: Column, before: Column) -> dict[str, Column]:
    """What the final classifier sees of a candidate: a few classes each."""
    n = F.length(match)
    return {
        "length": F.least(F.floor(n / 8), F.lit(8)).cast("string"),
        "digits": F.floor(4 * F.length(_digits(match)) / n).cast("string"),
        "case": F.concat(match.rlike("[a-z]").cast("int"), match.rlike("[A-Z]").cast("int")),
        "other": match.rlike("[_+/-]").cast("string"),
        "hex": match.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("string"),
        "left": F.when(before.rlike(r"[=:][\"' ]*$"), "assigned").when(before.rlike(r"[/#]$"), "path").otherwise("free"),
    }


VOTERS = ("regex", "gazetteer", "context", "spread")
SHAPE = ("length", "digits", "case", "other", "hex", "left")


def reliabilities(counts: Sequence[tuple[tuple[int, ...], int]], rounds: int = 60) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over (votes, count): the share of personal candidates, and for each labeler
    the chance of each vote given (not personal, personal)."""
    post = {v: (1.0 + 2 * v.count(1)) / (2.0 + 2 * v.count(1) + 4 * v.count(0) + (1 - min(1, v.count(1))) * 2) for v, _ in counts}
    share, tables = 0.5, []
    for _ in range(rounds):
        total = sum(n for _, n in counts)
        share = min(max((sum(post[v] * n for v, n in counts) + 1) / (total + 2), 1e-4), 1 - 1e-4)
        tables = []
        for k in range(len(VOTERS)):
            table = {}
            for vote in (-1, 0, 1):
                # a labeler is held to be better than chance: its votes start from one count on the right side
                own = [(1.0 if vote != 1 else 0.2), (1.0 if vote != 0 else 0.2)]
                for v, n in counts:
                    if v[k] == vote:
                        own[0] += (1 - post[v]) * n
                        own[1] += post[v] * n
                table[vote] = own
            sums = [sum(t[c] for t in table.values()) for c in (0, 1)]
            tables.append({vote: (t[0] / sums[0], t[1] / sums[1]) for vote, t in table.items()})
        post = {v: posterior(v, share, tables) for v, _ in counts}
    return share, tables


def posterior(votes: Sequence[int], share: float, tables: Sequence[dict[int, tuple[float, float]]]) -> float:
    odds = math.log(share / (1 - share)) + sum(math.log(t[v][1] / t[v][0]) for v, t in zip(votes, tables, strict=True))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def classifier(patterns: Sequence[tuple[dict[str, str], float, float]]) -> tuple[float, dict[str, dict[str, float]]]:
    """Naive Bayes from (shape, expected personal, expected other): the prior log-odds and each shape class's log-odds."""
    yes, no = sum(p for _, p, _ in patterns) + 1, sum(q for *_, q in patterns) + 1
    odds: dict[str, dict[str, float]] = {}
    for name in SHAPE:
        sums: dict[str, list[float]] = {}
        for shape, p, q in patterns:
            own = sums.setdefault(shape[name], [0.5, 0.5])
            own[0] += p
            own[1] += q
        odds[name] = {value: math.log(p / yes) - math.log(q / no) for value, (p, q) in sums.items()}
    return math.log(yes / no), odds


def _of_kind(spans: Column, order: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _count(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _candidates(text: Column) -> dict[str, Column]:
    """Candidates of each added kind; a text is searched only if it holds what every match must hold."""
    titles, digit = "|".join(TITLES), text.rlike("[0-9]")
    some = lambda cond, pattern: F.when(cond, found(text, pattern)).otherwise(_none())
    return {"secret": some(digit, CANDIDATE), "iban": some(digit, IBAN), "national_id": some(digit, NATIONAL), "person": some(F.lit(True), PERSON.replace("{titles}", titles).replace("{leads}", "|".join(LEADS))), "address": some(digit, ADDRESS)}


#: Stands for each character of a base span while candidates are looked for.
MASK = "\ufffc"


def searched(docs: DataFrame, base: str, maybe: str) -> DataFrame:
    """Add to ``docs`` the columns ``base`` (base spans, sorted) and ``maybe`` (candidates with kind, votes and shapes).

    Base spans are masked before candidates are looked for, so that none overlaps one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = base_spans(text)
    spans = F.array_sort(F.concat(*[_of_kind(kinds[k], i, k) for i, k in enumerate(KINDS)]))
    masked, *names = fresh(docs.withColumn(base, F.lit(0)).withColumn(maybe, F.lit(0)), "_masked", *(f"_{k}" for k in ADDED))
    out = docs.withColumn(base, spans)
    out = out.withColumn(masked, matches.replaced(text, F.col(base), f"repeat('{MASK}', greatest(s.end - greatest(at, s.start), 0))"))
    out = out.withColumns(dict(zip(names, _candidates(F.col(masked)).values(), strict=True)))

    def judged(kind: str):
        def one(c: Column) -> Column:
            head = F.regexp_extract(c["match"], r"[^.0-9]*+[0-9][^.]*+", 0) if kind == "secret" else c["match"]  # a dotted token is judged by its first part with a digit
            votes, shape = _votes(kind, head, c["before"], c["match"]), _shape(head, c["before"])
            return F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.struct(*[v.cast("int").alias(k) for k, v in votes.items()]).alias("votes"), F.struct(*[v.alias(k) for k, v in shape.items()]).alias("shape"))

        return one

    free = dict(zip(ADDED, map(F.col, names), strict=True))
    # an account number that passes its check is no secret; it has the same start or holds the candidate's
    accounts = F.filter(free["iban"], lambda b: mod97(b["match"]))
    free["secret"] = F.when(F.size(accounts) == 0, free["secret"]).otherwise(F.filter(free["secret"], lambda c: ~F.exists(accounts, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
    return out.withColumn(maybe, F.concat(*[F.transform(c, judged(k)) for k, c in free.items()])).drop(masked, *names)


def classified(seen: DataFrame, base: str, maybe: str, into: str) -> DataFrame:
    """Turn ``base`` and ``maybe`` of ``seen`` into ``into``: sorted array<struct<start, order, kind, end>>.

    Without candidates the fixed kinds are all there is. Spans of different
    kinds may overlap; an added span overlaps no base span.
    """
    each = seen.select(F.explode(maybe).alias("c")).select("c.kind", "c.votes.*", "c.shape.*")
    rows = each.groupBy("kind", *VOTERS, *SHAPE).count().collect()  # at most 5 kinds times 81 vote patterns times the shape classes

    def personal(kind: str, c: Column) -> Column:
        own = [r for r in rows if r.kind == kind]
        by_votes: dict[tuple[int, ...], int] = {}
        for r in own:
            votes = tuple(r[v] for v in VOTERS)
            by_votes[votes] = by_votes.get(votes, 0) + r["count"]
        share, tables = reliabilities(sorted(by_votes.items()))
        prior, odds = classifier([({s: r[s] for s in SHAPE}, p * r["count"], (1 - p) * r["count"]) for r in own for p in [posterior([r[v] for v in VOTERS], share, tables)]])
        total = F.lit(prior)
        for name in SHAPE:
            for value, weight in odds[name].items():
                total = total + F.when(c["shape"][name] == value, weight).otherwise(0.0)
        # the labelers' own posterior, where they voted, counts beside the shape
        for voter, t in zip(VOTERS, tables, strict=True):
            for vote in (0, 1):
                total = total + F.when(c["votes"][voter] == vote, math.log(t[vote][1] / t[vote][0])).otherwise(0.0)
        called = F.greatest(*[c["votes"][v] for v in VOTERS]) == 1
        return (c["kind"] == kind) & called & (total > 0)

    with_rows = {r.kind for r in rows}
    added = [_of_kind(F.filter(maybe, partial(personal, k)), len(KINDS) + i, k) for i, k in enumerate(ADDED) if k in with_rows]
    return seen.withColumn(into, F.array_sort(F.concat(base, *added))).drop(base, maybe)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and ``found`` for every row of ``docs`` (doc_id, text; other columns are ignored).

    The texts are searched once: the spans and candidates are checkpointed,
    without the texts. Defined cases: a null text is empty and, like an empty
    one, holds no span; texts are searched whole, in time linear in their
    length; rows alike are searched one by one; an empty table gives no rows.
    """
    return classified(checkpointed(searched(docs.select("doc_id", "text"), "_base", "_maybe").drop("text")), "_base", "_maybe", "found")


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the count of each fixed kind, base_sha256, and all spans as kind:start:end."""
    base = F.filter("found", lambda s: s["order"] < len(KINDS))
    return detect(docs).select("doc_id", *[_count("found", k) for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are replaced once. n_chars follows.

    The texts are searched once: they are checkpointed with their spans and candidates.
    The columns of ``docs`` stay as they are, whatever their names; cases as in
    ``detect``, and a null text stays null.
    """
    base, maybe, spans = fresh(docs, "_base", "_maybe", "_spans")
    seen = classified(checkpointed(searched(docs, base, maybe)), base, maybe, spans)
    name = "CASE WHEN s.start >= at THEN concat('[', upper(s.kind), ']') ELSE '' END"
    out = seen.withColumn("text", F.when(F.size(spans) > 0, matches.replaced(F.col("text"), F.col(spans), name)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
