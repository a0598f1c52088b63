"""Personal data: base rules, and a gradient-boosted choice among further candidates.

Base spans are the leftmost non-overlapping matches of one pattern for each kind
that pass its check (octets, Luhn, number of digits). They always stay.

Beyond them, generators of high recall propose spans that may overlap: addresses
with written-out signs, numbers with other separators, telephone numbers without
a plus. Boosted trees judge each proposal by its format and by the words around it.
They learn from proposals that a base span confirms, as they are and rewritten with other
separators, written-out signs or without the plus. On the other side are proposals that fail
their kind's check or lie in a base span of another kind, and made ones: words of the texts
around a bare "at" and "dot", broken addresses, and numbers after words such as "version" or
"invoice". All other proposals are what the trees are asked about. A kind without confirmed
proposals cannot be calibrated, and nothing is added to it. Learning takes a share, bounded for each kind and label; for each
kind a threshold is calibrated on all known proposals outside of it so that at least
``PRECISION`` of those above it are right. Overlapping selected proposals are taken
best first.

Everything is DataFrame functions. The text is scanned once; what the scan finds
is stored. Arrays of one text are built in blocks and met by one sorted pass, so a text
of very many spans costs little more than as many texts of few.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import cut, let, stored

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000
PRECISION = 0.98
#: Score bins of each kind when its threshold is calibrated.
BINS = 10_000
TREES, DEPTH = 10, 3
#: Partitions of what is learnt from: it is bounded, and each level of a tree is a job over all of them.
PARTS = 4
CONTEXT = 24
#: Entries that are handled together where arrays of one text are built or spans are compared.
BLOCK = 256

# The base patterns. A quantifier that takes all it can without giving back, and a look at
# the character before, keep them linear on long runs; they match what the plain ones do.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: What a text must hold for any match of a kind; texts without it are passed over.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
PROPOSAL_NEEDS = {"email": r"@|(?i:[\s(\[{]dot[\s)\]}])", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}

#: Generators of proposals; each takes bounded runs only.
PROPOSE = {
    "email": r"(?i)(?<![\w.%+-])[\w.%+-]{1,64}+(?:(?:\s?[(\[{]\s?at\s?[)\]}]\s?|\s?@\s?)[\w-]{1,63}+(?:(?:\s?[(\[{]\s?dot\s?[)\]}]\s?|\.)[\w-]{1,63}+){1,6}+|\sat\s[\w-]{1,63}+(?:\sdot\s[\w-]{1,63}+){1,6}+)",
    "ip": r"(?<![\w.])[0-9]{1,3}+(?:(?:\s?\[\.\]\s?|\s?\(\.\)\s?|\.)[0-9]{1,3}+){3}+(?![\w])",
    "card": r"(?<![\w+])[0-9]{2,19}+(?:[\x20._/-]{1,2}+[0-9]{2,6}+){0,6}+(?!\w)",
    "phone": r"(?<![\w.])(?:\+|00)?\(?[0-9]{1,4}+\)?(?:[\x20./-]{0,2}+\(?[0-9]{2,4}+\)?){2,5}+(?!\w)",
}
CUES = {
    "email": r"(?i)mail|contact|write|@|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|address|addr",
    "card": r"(?i)card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|fax|mobile|cell|whatsapp",
}
# fixed values: words after which a number or address is none, by kind
OTHERWISE = {
    "email": ("looked ", "arrived ", "met "),
    "ip": ("version ", "release ", "section ", "build "),
    "card": ("order ", "serial ", "part ", "tracking "),
    "phone": ("invoice ", "isbn ", "order ", "lines "),
}
# fixed values: top-level domains that addresses end in most often
TOP_LEVEL = r"(?i)^(?:com|org|net|edu|gov|mil|int|info|biz|io|ai|app|dev|co|me|tv|example|test|uk|de|fr|es|it|nl|be|ch|at|se|no|dk|fi|pl|cz|pt|gr|ie|eu|ru|ua|tr|us|ca|mx|br|ar|cl|au|nz|jp|cn|hk|tw|kr|in|sg|za|il)$"
FEATURES = ("kind_no", "bare", "bracketed", "known_end", "otherwise", "length", "digits", "letters", "groups", "dots", "hyphens", "spaces", "luhn", "octets", "first_group", "last_group", "cue", "word_before", "word_after")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def valid(kind: str, m: Column) -> Column:
    d = _digits(m)
    return {
        "email": F.lit(True),
        "ip": m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False),
        "phone": F.length(d).between(9, 15),
    }[kind]


def blocks(items: Column) -> Column:
    """``items`` as arrays of at most ``BLOCK`` entries; one empty array if there are none."""
    last = F.greatest(F.floor((F.size(items) - 1) / BLOCK), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))


def gathered(items: Column, zero: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column, Column]], kind: str) -> Column:
    """What ``step`` gives over ``items``, in order: an array of ``kind``.

    ``step(state, item)`` returns the next state, whether a value is given, and the value.
    An array that grows is copied at each append, so values grow in arrays of one block.
    """
    none, no_blocks = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def one(acc: Column, x: Column) -> Column:
        state, gives, value = step(acc, x)
        return F.struct(*(v.alias(n) for n, v in state.items()), F.when(gives, F.array_append(acc["out"], value)).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(*(acc[n].alias(n) for n in zero), none.alias("out")), one)
        return let(inner, lambda i: F.struct(*(i[n].alias(n) for n in zero), F.array_append(acc["all"], i["out"]).alias("all")))

    start = F.struct(*(v.alias(n) for n, v in zero.items()), no_blocks.alias("all"))
    return F.flatten(let(items, lambda v: F.aggregate(blocks(v), start, block, lambda acc: acc["all"])))


def spans(text: Column, pattern: str, test: Callable[[Column], Column], needs: str | None = None, context: bool = False) -> Column:
    """Start, end (code points) and text of the matches that pass ``test``.

    With ``context`` also what is before and after: up to ``CONTEXT`` code points, at most
    to the far end of the matches beside it.
    """
    around = ",before:string,after:string" if context else ""
    kind = f"struct<s:int,e:int,m:string{around}>"

    def located(p: Column) -> Column:
        at = lambda a, i: F.coalesce(F.get(p[a], i), F.lit(""))
        beside = lambda i: (
            F.right(F.concat(at("found", i - 1), at("gaps", i)), F.lit(CONTEXT)).alias("before"),
            F.substring(F.concat(at("gaps", i + 1), at("found", i + 1)), 1, CONTEXT).alias("after"),
        )
        return F.transform(p["found"], lambda m, i: F.struct(F.length(at("gaps", i)).alias("gap"), F.length(m).alias("n"), m.alias("m"), *(beside(i) if context else ())))

    def step(acc: Column, x: Column) -> tuple[dict[str, Column], Column, Column]:
        start = acc["pos"] + x["gap"]
        more = [x[c].alias(c) for c in ("before", "after")] if context else []
        return {"pos": start + x["n"]}, test(x["m"]), F.struct(start.alias("s"), (start + x["n"]).alias("e"), x["m"].alias("m"), *more)

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    found = gathered(let(both, located), {"pos": F.lit(0)}, step, kind)
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(f"array<{kind}>")) if needs else found


def _labelled(kind: str, found: Column) -> Column:
    no = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(no).alias("k"), x["e"].alias("e"), x["m"].alias("m")))


def base_spans(text: Column) -> Column:
    """Base spans of all kinds by start, then kind: array of (s, k, e)."""
    each = [_labelled(k, spans(text, BASE[k], lambda m, k=k: valid(k, m), NEEDS.get(k))) for k in KINDS]
    return F.transform(F.sort_array(F.concat(*each)), lambda x: F.struct(x["s"], x["k"], x["e"]))


def _met(no: int, found: Column, base: Column) -> Column:
    """For each of the proposals ``found`` of a kind: whether a base span confirms it, and whether any meets it.

    One pass over both, by position. A base span of the same kind confirms a proposal if it
    covers four fifths of it; it then covers the middle, and there is one at most. A
    proposal is met if some base span that starts before its end reaches over its start.
    """
    event = lambda at, what, x: F.struct(at.alias("at"), F.lit(what).alias("what"), x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))
    events = F.concat(
        F.transform(found, lambda x: event(x["e"], 0, x)),
        F.transform(base, lambda x: event(x["s"], 1, x)),
        F.transform(found, lambda x: event((x["s"] + F.floor((x["e"] - x["s"]) / 2)).cast("int"), 2, x)),
    )
    zero = {"reach": F.lit(-1), "s": F.lit(-1), "e": F.lit(-1), "confirmed": F.lit(False)}

    def step(acc: Column, x: Column) -> tuple[dict[str, Column], Column, Column]:
        is_base = x["what"] == 1
        own = is_base & (x["k"] == no)
        covered = F.least(acc["e"], x["e"]) - F.greatest(acc["s"], x["s"]) >= 0.8 * (x["e"] - x["s"])
        state = {
            "reach": F.when(is_base, F.greatest(acc["reach"], x["e"])).otherwise(acc["reach"]),
            "s": F.when(own, x["s"]).otherwise(acc["s"]),
            "e": F.when(own, x["e"]).otherwise(acc["e"]),
            "confirmed": F.when(x["what"] == 2, covered).otherwise(acc["confirmed"]),
        }
        return state, x["what"] == 0, F.struct(acc["confirmed"].alias("confirmed"), (acc["reach"] > x["s"]).alias("taken"))

    return gathered(F.sort_array(events), zero, step, "struct<confirmed:boolean,taken:boolean>")


def _proposals_of(no: int, text: Column, base: Column) -> Column:
    names = ("s", "k", "e", "m", "before", "after")
    found = spans(text, PROPOSE[KINDS[no]], lambda m: F.lit(True), PROPOSAL_NEEDS[KINDS[no]], context=True)
    labelled = F.transform(found, lambda x: F.struct(*((F.lit(no) if c == "k" else x[c]).alias(c) for c in names)))

    def with_met(v: Column) -> Column:
        met = F.when(F.size(v) > 0, _met(no, v, base))
        return let(met, lambda y: F.transform(v, lambda x, i: F.struct(*(x[c].alias(c) for c in names), *(F.get(y, i)[c].alias(c) for c in ("confirmed", "taken")))))

    return let(labelled, with_met)


def _proposals(text: Column, base: Column) -> Column:
    """Proposals of all kinds: array of (s, k, e, m, before, after, confirmed, taken)."""
    return F.concat(*(_proposals_of(no, text, base) for no in range(len(KINDS))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: bool = False) -> DataFrame:
    """row, doc_id, digest of the text, base spans, proposals; a null text counts as empty.

    With ``carried`` the whole row comes too, as the struct ``whole``.
    """
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")] if carried else []
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), *whole)
    kept = ["whole"] if carried else []
    seen = let(base_spans(F.col("t")), lambda b: F.struct(b.alias("base"), _proposals(F.col("t"), b).alias("proposed")))
    rows = rows.select("row", "doc_id", *kept, F.md5(F.col("t").cast("binary")).alias("digest"), seen.alias("seen"))
    return rows.select("row", "doc_id", *kept, "digest", "seen.base", "seen.proposed")


#: How confirmed spans are rewritten to learn from: separators of groups of card digits.
SEPARATORS = (".", "/", "_", "  ", " ", "-")


def _made(k: Column, m: Column, before: Column, after: Column) -> Column:
    """What is made of a confirmed match to learn from: an array of (m, before, good).

    Good are other spellings of it: written-out signs, other separators, telephone numbers
    without a plus, with a double zero, without their country. Not good are words of the text
    around a bare "at" and "dot", broken addresses, and spellings after words of ``OTHERWISE``.
    """
    draw = F.crc32(m.cast("binary"))
    one_of = lambda options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(draw, F.lit(len(options))) + 1).cast("int"))
    it = lambda text, good, ahead=before: F.struct(text.alias("m"), ahead.alias("before"), F.lit(good).alias("good"))
    otherwise = lambda kind: one_of(OTHERWISE[kind])
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    spelt = lambda left, right: F.concat(local, F.lit(f" {left}at{right} "), F.replace(domain, F.lit("."), F.lit(f" {left}dot{right} ")))
    near = F.filter(F.regexp_extract_all(F.concat_ws(" ", before, after), F.lit("[A-Za-z]{2,12}"), F.lit(0)), lambda w: ~w.rlike(TOP_LEVEL))
    word = lambda v, i: F.get(v, F.pmod(F.lit(i), F.size(v)))
    phrase = lambda v: F.concat(word(v, 0), F.lit(" at "), word(v, 1), F.lit(" dot "), word(v, 2))
    phrases = let(near, lambda v: F.when(F.size(v) > 0, F.array(it(phrase(v), 0.0), it(phrase(F.reverse(v)), 0.0))).otherwise(F.array(it(F.concat(local, F.lit(" at "), local, F.lit(" dot "), local), 0.0))))
    email = F.concat(F.array(it(spelt("[", "]"), 1.0), it(spelt("(", ")"), 1.0), it(spelt("", ""), 1.0), it(F.concat(local, F.lit("@"), F.regexp_replace(domain, "[.][^.]*$", ".7")), 0.0)), phrases)
    dots, last = F.replace(m, F.lit("."), F.lit("[.]")), F.concat(F.substring_index(m, ".", 3), F.lit("[.]"), F.substring_index(m, ".", -1))
    ip = F.array(it(dots, 1.0), it(last, 1.0), it(dots, 0.0, otherwise("ip")), it(last, 0.0, otherwise("ip")), it(F.regexp_replace(dots, "[0-9]+$", "999"), 0.0))
    grouped = lambda d: F.array_join(F.regexp_extract_all(d, F.lit("[0-9]{1,4}"), F.lit(0)), "\x00")
    card_text = F.replace(grouped(_digits(m)), F.lit("\x00"), one_of(SEPARATORS))
    card = F.array(it(card_text, 1.0), it(card_text, 0.0, otherwise("card")))
    national = F.replace(F.regexp_replace(F.regexp_replace(m, r"^\+[0-9]{1,3}[^0-9]+", ""), "[^0-9]+", "\x00"), F.lit("\x00"), one_of(SEPARATORS))
    plain, zeros = F.substring(m, 2, 1 << 20), F.concat(F.lit("00"), F.substring(m, 2, 1 << 20))
    phone = F.array(it(plain, 1.0), it(zeros, 1.0), it(national, 1.0), it(plain, 0.0, otherwise("phone")), it(national, 0.0, otherwise("phone")))
    return F.when(k == 0, email).when(k == 1, ip).when(k == 2, card).otherwise(phone)


def candidates(scanned: DataFrame) -> DataFrame:
    """A row for each proposal and each made one: its features and label.

    ``label`` is 1 where a base span of its kind confirms the proposal, 0 where the
    proposal fails its kind's check or meets a base span, and null where it is open. Made
    ones have the label that they are made for, but 0 where they fail the check.
    """
    c = scanned.select("row", "digest", F.explode("proposed").alias("p")).select("row", "digest", "p.*")
    itself = F.array(F.struct("m", "before", F.lit(None).cast("double").alias("good")))
    more = F.when(F.col("confirmed"), _made(F.col("k"), F.col("m"), F.col("before"), F.col("after")))
    forms = F.concat(itself, F.coalesce(more, F.array().cast("array<struct<m:string,before:string,good:double>>")))
    c = c.select("row", "digest", "s", "k", "e", "after", "confirmed", "taken", F.posexplode(forms).alias("made", "f")).select("*", "f.*").drop("f")
    # format features are those of the usual spelling
    c = c.withColumns({"bare": F.col("m").rlike(r"(?i)\s(?:at|dot)\s"), "bracketed": F.col("m").rlike(r"[\[({]")})
    c = c.withColumn("m", F.regexp_replace(F.regexp_replace("m", r"(?i)\s?[(\[{]\s?at\s?[)\]}]\s?|\sat\s|\s?@\s?", "@"), r"(?i)\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\sdot\s", "."))
    d, cue, otherwise = _digits(F.col("m")), F.lit(None).cast("boolean"), F.lit(None).cast("boolean")
    for no, k in enumerate(KINDS):
        cue = F.when(F.col("k") == no, F.col("before").rlike(CUES[k])).otherwise(cue)
        otherwise = F.when(F.col("k") == no, F.col("before").rlike(rf"(?i)\b(?:{'|'.join(w.strip() for w in OTHERWISE[k])})\b[^\w]*(?:no\b|number\b|nr\b)?[^\w]*$")).otherwise(otherwise)
    groups = F.filter(F.split("m", "[^0-9]+"), lambda x: x != "")
    length = lambda x: F.coalesce(F.length(x), F.lit(0))
    luhn = F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False)
    octets = F.regexp_replace("m", r"[\[\]()\s]", "").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    as_double = {
        "kind_no": F.col("k"), "bare": F.col("bare"), "bracketed": F.col("bracketed"), "known_end": F.substring_index("m", ".", -1).rlike(TOP_LEVEL), "otherwise": otherwise,
        "length": F.length("m"), "digits": F.length(d), "letters": F.length(F.regexp_replace("m", "[^A-Za-z]", "")), "groups": F.size(groups),
        "dots": F.length(F.regexp_replace("m", "[^.]", "")), "hyphens": F.length(F.regexp_replace("m", "[^-]", "")), "spaces": F.length(F.regexp_replace("m", r"[^\x20]", "")),
        "luhn": luhn, "octets": octets, "first_group": length(F.get(groups, 0)), "last_group": length(F.try_element_at(groups, F.lit(-1))),
        "cue": cue, "word_before": F.col("before").rlike(r"\w\s?$"), "word_after": F.col("after").rlike(r"^\s?\w"),
    }
    passes = F.when(F.col("k") == 0, F.col("m").rlike(r"@[^@]*\.[^@.]*[A-Za-z]{2}[^@.]*$")).when(F.col("k") == 1, octets).when(F.col("k") == 2, luhn).otherwise(F.length(d).between(9, 15))
    label = F.when(F.col("made") > 0, F.when(passes, F.col("good")).otherwise(0.0)).when(F.col("confirmed"), 1.0).when(F.col("taken") | ~passes, 0.0)
    return c.select("row", "digest", "s", "k", "e", "made", *(F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for n, v in as_double.items()), label.alias("label"))


def choose(cands: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """row, s, k, e of the proposals that the boosted trees add to the base spans."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    known = cands.where("label IS NOT NULL")
    counts = {(r.k, r.label): r["count"] for r in known.groupBy("k", "label").count().collect()}  # eight rows at most
    # a share of each kind and label learns: half of it, but no more than a bound. The hash is of the
    # text and the place in it, so copies of a text learn together, and once
    u = F.pmod(F.xxhash64("digest", "s", "k"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = {g: min(0.5, sample / 2 / len(KINDS) / 2 / n) for g, n in counts.items()}
    by_group = lambda of: F.coalesce(*(F.when((F.col("k") == k) & (F.col("label") == y), F.lit(float(v))) for (k, y), v in of.items()), F.lit(0.0))
    vectors = lambda df: VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)
    learns = u < by_group(share)
    part = cut(vectors(known.where(learns).dropDuplicates(["digest", "s", "k", "made"])).select("k", "label", "features").coalesce(PARTS))
    taken = {(r.k, r.label): r["count"] for r in part.groupBy("k", "label").count().collect()}
    # each kind has trees of its own; its labels weigh as in all its proposals
    models = {}
    for k in range(len(KINDS)):
        if (k, 0.0) in taken and (k, 1.0) in taken:
            weight = {(k, y): 1000.0 * counts[k, y] / (counts[k, 0.0] + counts[k, 1.0]) / taken[k, y] for y in (0.0, 1.0)}
            models[k] = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1, weightCol="weight").fit(part.where(F.col("k") == k).withColumn("weight", by_group(weight)))
    if not models:
        return cands.where(F.lit(False)).select("row", "s", "k", "e")

    def rated(df: DataFrame) -> DataFrame:
        each = [m.transform(vectors(df.where(F.col("k") == k))).withColumn("p", vector_to_array("probability")[1]) for k, m in models.items()]
        return reduce(DataFrame.unionByName, (d.select("row", "s", "k", "e", "label", "p") for d in each))

    # all known proposals that did not learn, as counts of score bins
    judged = rated(known.where(~learns)).groupBy("k", F.floor(F.col("p") * BINS).alias("bin"))
    bins = cut(judged.agg(F.count("*").alias("n"), F.sum("label").alias("good"), F.min("p").alias("low"), F.max("p").alias("top")))
    above = W.partitionBy("k").orderBy(F.desc("bin"))
    ranked = bins.withColumn("right", F.sum("good").over(above) / F.sum("n").over(above)).withColumn("next", F.lead("top").over(above))
    accepted = ranked.where((F.col("right") >= precision) & (F.col("good") > 0)).groupBy("k").agg(F.min(F.struct("low", "next")).alias("last"))
    # a limit lies half-way to the best bin that is not accepted, and above one half
    limits = accepted.select("k", F.greatest((F.col("last.low") + F.coalesce(F.col("last.next"), F.lit(0.0))) / 2, F.lit(0.5)).alias("limit"))
    picked = rated(cands.where("label IS NULL")).join(F.broadcast(limits), "k").where("p >= limit").select("row", "s", "k", "e", "p")  # four limits at most
    # spans that overlap one another are one cluster; there they are taken best first. A chain of very many
    # goes by stretches of a block in the order of the text; where two meet over a border, the earlier stays
    by_start = W.partitionBy("row").orderBy("s", "e", "k")
    reached = F.coalesce(F.max("e").over(by_start.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    clustered = picked.withColumn("new", (F.col("s") >= reached).cast("int")).withColumn("cluster", F.sum("new").over(by_start))
    stretch = F.floor((F.row_number().over(W.partitionBy("row", "cluster").orderBy("s", "e", "k")) - 1) / BLOCK)
    ranked = clustered.withColumn("stretch", stretch).groupBy("row", "cluster", "stretch").agg(F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("o"), (F.col("s") - F.col("e")).alias("n"), "k", "s", "e"))).alias("all"))
    clash = lambda acc, x: F.exists(acc, lambda y: (y["s"] < x["e"]) & (y["e"] > x["s"]))
    none = F.array().cast("array<struct<o:double,n:int,k:int,s:int,e:int>>")
    best = F.aggregate("all", none, lambda acc, x: F.when(clash(acc, x), acc).otherwise(F.array_append(acc, x)))
    chosen = ranked.select("row", F.explode(best).alias("x")).select("row", "x.s", "x.k", "x.e")
    in_order = F.sort_array(F.collect_list(F.struct("s", "e", "k")))
    keep = lambda acc, x: ({"pos": F.when(x["s"] >= acc["pos"], x["e"]).otherwise(acc["pos"])}, x["s"] >= acc["pos"], x)
    chosen = chosen.groupBy("row").agg(in_order.alias("all")).select("row", F.explode(gathered(F.col("all"), {"pos": F.lit(-1)}, keep, "struct<s:int,e:int,k:int>")).alias("x"))
    return chosen.select("row", "x.s", "x.k", "x.e")


def _found(scanned: DataFrame) -> DataFrame:
    """The stored scan with ``spans``: base spans and the added ones by start, then kind."""
    added = stored(choose(stored(candidates(scanned))).groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("added")))
    both = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return scanned.drop("proposed").join(added, "row", "left").withColumn("spans", both).drop("added")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, base, spans for each row: base spans, and these with the added ones.

    Both are arrays of (start, kind number, end) by start, then kind. Rows that share an
    id are separate documents, and repeated rows have the same spans; other columns are
    not read. Of overlapping added spans with equal scores the longer one is taken, then
    the first kind, then the first start. Without any text nothing is found. Patterns take
    what they can without giving back, and no step compares all spans of a text with one
    another, so very long runs and very many spans of one text are found as all others are.
    """
    return _found(stored(scan(docs, id_col, text_col))).select("doc_id", "digest", "base", "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span in the text replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first. A null text stays null, an empty one
    empty; repeated rows are all kept. A text of very many spans is cut by blocks of them.
    ``n_chars``, if there, is counted anew where the text changed. Rows are stored with what the scan finds and
    read again, so other columns may have any name, and texts are shuffled only if the
    added spans are too many for Spark to broadcast.
    """
    found = _found(stored(scan(docs, id_col, text_col, carried=True)))
    own = lambda c: F.col("whole").getField(c)
    text = own(text_col)
    name = lambda k: F.concat(F.lit("<"), F.element_at(F.array(*map(F.lit, KINDS)), k + 1), F.lit(">"))

    def step(acc: Column, x: Column) -> tuple[dict[str, Column], Column, Column]:
        kept = F.struct(acc["pos"].alias("a"), x["s"].alias("b"), x["k"].alias("k"))
        return {"pos": F.greatest(acc["pos"], x["e"])}, x["s"] >= acc["pos"], kept

    def written(part: Column) -> Column:
        # what a block of spans covers is cut out of the text once
        start = part[0]["a"]
        region = F.substring(text, start + 1, F.element_at(part, -1)["b"] - start)
        return let(region, lambda t: F.array_join(F.transform(part, lambda x: F.concat(F.substring(t, x["a"] - start + 1, x["b"] - x["a"]), name(x["k"]))), ""))

    hit = F.size("spans") > 0
    kept = gathered(F.col("spans"), {"pos": F.lit(0)}, step, "struct<a:int,b:int,k:int>")
    end = F.array_max(F.transform("spans", lambda x: x["e"]))
    clean = F.concat(let(kept, lambda v: F.array_join(F.transform(blocks(v), written), "")), F.substring(text, end + 1, F.length(text)))
    clean = F.when(hit, clean).otherwise(text)
    columns = {text_col: clean}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(hit, F.length(clean)).otherwise(own("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*(columns.get(c, own(c)).alias(c) for c in docs.columns))


def _written(found: str) -> Column:
    kind = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", kind(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op1_pii(spark, sf_dir: str) -> DataFrame:
    from tidewright.llm.common import read

    found = detect(read(spark, sf_dir, "documents"))
    count = lambda no: F.size(F.filter("base", lambda x: x["k"] == no)).cast("long")
    counts = [count(no).alias(f"n_{k}") for no, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"), _written("spans").alias("spans"))
