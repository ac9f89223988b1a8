"""Secret scans on built-in functions: fixed patterns, and a randomness test battery for every other long token.

The battery infers a token's encoding from its characters and tests how evenly it uses that alphabet (chi-squared), how
often it changes between classes of characters (runs) and whether neighbours go together (serial correlation).

A token is a find if it looks random and ordinary text would not. It must be consistent with random draws in all three
tests. Its p-value is the chance that an ordinary token of the same encoding and length looks as random: one whose
letters are as frequent as in English and whose classes change as seldom as in words, paths and identifiers. The exact
mean and variance of chi-squared for such tokens and a bound on the binomial tail for the changes give a p-value each, which
Fisher's product combines. The ordinary tokens' model is fixed, so a p-value depends on the token alone.

Benjamini and Hochberg's procedure over all tested tokens keeps the expected share of false finds at ``FALSE_FINDS``. It is
weighted by length, as the tests tell little about short tokens.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import packed_rows, stored

FALSE_FINDS = 0.05

# Kinds in their order, pattern, the group whose length counts, and its least length.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
RANDOM = "random"
# Every whole run of 20 or more of these characters, whatever stands around it; '=' only as trailing padding.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Encodings from narrow to wide; the first that has all characters of a token is taken to be its own.
ENCODINGS = {
    "digits": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "word": _LOWER,
    "WORD": _LOWER.upper(),
    "base32": _LOWER.upper() + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _LOWER.upper(),
    "letters": _LOWER.upper() + _LOWER,
    "base62": _LOWER.upper() + _LOWER + _DIGITS,
    "base64": _LOWER.upper() + _LOWER + _DIGITS + "+/",
    "any": _LOWER.upper() + _LOWER + _DIGITS + "+/-_",
}
LENGTHS = (20, 24, 32, 48, 64, 128)
# p-values are counted in steps of a 1 / STEPS power of two, the last step being open.
STEPS, LAST = 4, 400
# A token this many standard deviations off in a test is not consistent with random draws.
FAR = 3.3

# How often letters occur in English, in percent, from a to z.
ENGLISH = (
    8.17, 1.49, 2.78, 4.25, 12.70, 2.23, 2.02, 6.09, 6.97, 0.15, 0.77, 4.03, 2.41,
    6.75, 7.51, 1.93, 0.10, 5.99, 6.33, 9.06, 2.76, 0.98, 2.36, 0.15, 1.97, 0.07,
)
VOWELS = "aeiou"


@dataclass(frozen=True)
class Ordinary:
    """Ordinary tokens of an encoding: shares of lower-case letters, capitals, digits and marks, and of class changes."""

    lower: float
    upper: float
    digits: float
    marks: float
    changes: float

    def frequencies(self, alphabet: str) -> list[float]:
        """How often each symbol of the alphabet occurs."""
        letters = [x / sum(ENGLISH) for x in ENGLISH]
        groups = {"lower": self.lower, "upper": self.upper, "digits": self.digits, "marks": self.marks}
        weights = [letters[ord(c.lower()) - 97] if c.isalpha() else 1.0 for c in alphabet]
        sums = Counter()
        for c, w in zip(alphabet, weights):
            sums[_group(c)] += w
        shares = sum(groups[g] for g in sums)
        return [groups[_group(c)] / shares * w / sums[_group(c)] for c, w in zip(alphabet, weights)]


def _group(c: str) -> str:
    return "digits" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "marks"


# Digits are missing, as ordinary numbers look random. In words the classes are vowels and consonants, which take turns.
ORDINARY = {
    "hex": Ordinary(0.3, 0.0, 0.7, 0.0, 0.2),
    "HEX": Ordinary(0.0, 0.3, 0.7, 0.0, 0.2),
    "word": Ordinary(1.0, 0.0, 0.0, 0.0, 0.6),
    "WORD": Ordinary(0.0, 1.0, 0.0, 0.0, 0.6),
    "base32": Ordinary(0.0, 0.85, 0.15, 0.0, 0.15),
    "base36": Ordinary(0.85, 0.0, 0.15, 0.0, 0.15),
    "BASE36": Ordinary(0.0, 0.85, 0.15, 0.0, 0.15),
    "letters": Ordinary(0.85, 0.15, 0.0, 0.0, 0.25),
    "base62": Ordinary(0.75, 0.10, 0.15, 0.0, 0.25),
    "base64": Ordinary(0.70, 0.10, 0.10, 0.10, 0.30),
    "any": Ordinary(0.70, 0.10, 0.10, 0.10, 0.30),
}
WORDS = ("word", "WORD")


def random_changes(name: str) -> float:
    """The chance that two random neighbours of an encoding differ in class."""
    alphabet = ENCODINGS[name]
    shares = Counter((c.lower() in VOWELS) if name in WORDS else _group(c) for c in alphabet)
    return 1 - sum((n / len(alphabet)) ** 2 for n in shares.values())


SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, pattern: str, group: int, least: int, make) -> Column:
    """``make(start, end, match)`` of every match, from left to right, whose ``group`` has ``least`` characters.

    A match starts where the gaps and matches before it end; the gaps are what a split at the pattern leaves.
    """
    empty = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def placed(whole: Column) -> Column:
        value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
        rows = F.arrays_zip(whole.alias("m"), value.alias("v"), F.split(text, pattern, -1).alias("g"))

        def step(a: Column, z: Column) -> Column:
            start = a["at"] + F.length(z["g"])
            end = start + F.coalesce(F.length(z["m"]), F.lit(0))
            span = F.struct(start.alias("start"), end.alias("end"), z["m"].alias("text"))
            kept = F.when(F.length(z["v"]) >= least, F.array_append(a["spans"], span)).otherwise(a["spans"])
            return F.struct(end.alias("at"), kept.alias("spans"))

        first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        named = F.transform(rows, lambda z: F.struct(z["m"].alias("m"), z["v"].alias("v"), z["g"].alias("g")))
        return F.aggregate(named, first, step, lambda a: a["spans"])

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = _let(whole, lambda w: F.when(F.size(w) > 0, placed(w)).otherwise(empty))
    return F.transform(found, lambda s: make(s["start"], s["end"], s["text"]))


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns, by start and then kind."""
    spans = []
    for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        make = lambda start, end, _, r=rank, k=kind: F.struct(
            start.alias("start"), F.lit(r).alias("rank"), F.lit(k).alias("kind"), end.alias("end")
        )
        spans.append(_matches(text, pattern, group, least, make).cast(f"array<{SPAN}>"))
    return F.sort_array(F.concat(*spans))


def _change_count(body: Column, words: Column) -> Column:
    """Between how many neighbours the class changes: one less than the runs of equal classes."""
    upper = _LOWER.upper()
    by_group = F.translate(body, _LOWER + upper + _DIGITS + "+/-_", "a" * 26 + "A" * 26 + "0" * 10 + "-" * 4)
    by_sound = F.translate(F.lower(body), _LOWER, "".join("a" if c in VOWELS else "b" for c in _LOWER))
    return F.length(F.regexp_replace(F.when(words, by_sound).otherwise(by_group), r"(.)\1*", "x")) - 1


def battery(token: Column) -> Column:
    """``encoding`` and ``p`` of a token, as a struct: the chance that an ordinary token looks as random."""
    body = F.rtrim(token, F.lit("="))
    table = []
    for name, alphabet in ENCODINGS.items():
        own = ORDINARY.get(name)
        q = own.frequencies(alphabet) if own else [1 / len(alphabet)] * len(alphabet)
        powers = (sum(x**2 for x in q), sum(x**3 for x in q))
        values = (float(len(alphabet)), *powers, own.changes if own else 0.0, random_changes(name))
        fields = zip(("k", "s2", "s3", "often", "even"), values)
        table.append(F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"), *(F.lit(v).alias(n) for n, v in fields)))
    fit = F.filter(F.array(*table), lambda e: F.call_function("translate", body, e["alphabet"], F.lit("")) == "")[0]

    def scores(c: Column) -> Column:
        e, codes = c["e"], c["codes"]
        k, n = e["k"], F.size(codes).cast("double")
        add = lambda f, over: F.aggregate(F.transform(over, f), F.lit(0.0), lambda a, b: a + b)
        after = lambda x, i: F.get(codes, i + 1)
        # uniformity: in sorted codes the j-th of a run of equals adds 2 j - 1 to the sum of squared counts
        tally = F.aggregate(
            F.sort_array(codes),
            F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")),
            lambda a, x: _let(
                F.when(x == a["last"], a["run"] + 1.0).otherwise(1.0),
                lambda run: F.struct(x.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).alias("sum")),
            ),
            lambda a: a["sum"],
        )
        chi, free = tally * k / n - n, k - 1
        # Wilson and Hilferty's cube root makes it a standard score
        uniform = (F.pow(chi / free, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        mean = add(lambda x: x.cast("double"), codes) / n
        square = add(lambda x: (x - mean) * (x - mean), codes)
        product = add(lambda x, i: F.coalesce((x - mean) * (after(x, i) - mean), F.lit(0.0)), codes)
        serial = F.coalesce((F.try_divide(product, square) + 1 / n) * F.sqrt(n), F.lit(10.0))
        pairs, changes = n - 1, c["changes"].cast("double")
        # digits have one class and ordinary numbers look random: no find
        runs = F.coalesce(F.try_divide(changes - pairs * e["even"], F.sqrt(pairs * e["even"] * (1 - e["even"]))), F.lit(10.0))
        random = (uniform <= FAR) & (F.abs(runs) <= FAR) & (F.abs(serial) <= FAR)

        # the mean and variance of chi-squared when symbols are as frequent as in ordinary tokens
        usual = k * (1 - e["s2"]) + n * (k * e["s2"] - 1)
        spread = k / n * F.sqrt(2 * n * (n - 1) * (e["s2"] + 2 * (n - 2) * e["s3"] - (2 * n - 3) * e["s2"] * e["s2"]))
        z = (chi - usual) / spread
        even = F.when(z < 0, 0.5 * F.exp(-z * z / 2)).otherwise(1.0)
        # the tail of the binomial distribution is below this; words change class often, the others seldom
        part = lambda share, of: F.when(share > 0, share * F.ln(share / of)).otherwise(0.0)
        rate = changes / pairs
        beyond = F.when(e["name"].isin(*WORDS), rate < e["often"]).otherwise(rate > e["often"])
        bound = F.exp(-pairs * (part(rate, e["often"]) + part(1 - rate, 1 - e["often"])))
        both = even * F.when(beyond & (e["often"] > 0), bound).otherwise(1.0)
        p = F.when(random & (both > 0), both * (1 - F.ln(both))).when(random, 0.0).otherwise(1.0)
        return F.struct(e["name"].alias("encoding"), F.coalesce(p, F.lit(1.0)).alias("p"))

    coded = lambda e: F.struct(
        e.alias("e"),
        F.filter(F.transform(F.split(body, "", -1), lambda ch: F.position(ch, e["alphabet"]) - 1), lambda x: x >= 0).alias("codes"),
        _change_count(body, e["name"].isin(*WORDS)).alias("changes"),
    )
    return _let(_let(fit, coded), scores)


def length_class(size: Column) -> Column:
    """The number of the length class: how many of ``LENGTHS`` a size has reached, less one."""
    return sum((F.when(size >= n, 1).otherwise(0) for n in LENGTHS[1:]), F.lit(0))


def tested_tokens(text: Column) -> Column:
    """Every long token with its span, length class and the step of its p-value; high steps are small values."""

    def make(start: Column, end: Column, token: Column) -> Column:
        step = F.least(F.floor(-F.log2(F.greatest(battery(token)["p"], F.lit(1e-300))) * STEPS), F.lit(LAST))
        return F.struct(start.alias("start"), end.alias("end"), length_class(end - start).alias("length"), step.cast("int").alias("step"))

    return _matches(text, TOKEN, 0, LENGTHS[0], make)


def accepted_steps(tokens: DataFrame, false_finds: float = FALSE_FINDS) -> dict[int, int]:
    """The least step per length class that the false-discovery control accepts.

    ``tokens`` has ``length`` and ``step``. The counts that come to the driver are at most one row per length class and
    step. A token weighs as much as the least length of its class, and the weights are one on average.
    """
    counts = {(r["length"], r["step"]): r["count"] for r in tokens.groupBy("length", "step").count().collect()}
    total = sum(counts.values())
    weighed = sum(n * LENGTHS[length] for (length, _), n in counts.items())
    values = sorted((2.0 ** (-step / STEPS) * weighed / (total * LENGTHS[length]), length, step, n) for (length, step), n in counts.items())
    seen, limit = 0, -1.0
    for p, _, _, n in values:
        seen += n
        # values that are equal are accepted together: the last of them has seen them all
        if p <= false_finds * seen / total:
            limit = p
    steps: dict[int, int] = {}
    for p, length, step, _ in values:
        if p <= limit:
            steps[length] = min(steps.get(length, LAST), step)
    return steps


def random_spans(tokens: Column, base: Column, steps: dict[int, int]) -> Column:
    """Spans of accepted tokens that no span of ``base`` holds already."""
    test = lambda t: F.lit(False)
    for length, step in steps.items():
        test = lambda t, f=test, c=length, s=step: f(t) | ((t["length"] == c) & (t["step"] >= s))
    held = lambda t: F.exists(base, lambda b: (b["start"] <= t["start"]) & (b["end"] >= t["end"]))
    kept = F.filter(tokens, lambda t: test(t) & ~held(t))
    rank = len(KINDS)
    make = lambda t: F.struct(t["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(RANDOM).alias("kind"), t["end"].alias("end"))
    return F.transform(kept, make).cast(f"array<{SPAN}>")


def scan(docs: DataFrame, false_finds: float = FALSE_FINDS) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row: the fixed patterns' spans, and these with the battery's.

    ``docs`` needs doc_id and text; other columns are not read. Spans are in code points with the end exclusive. A null
    text is empty and has none. Repeated rows and null ids are scanned each. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", base_spans(text).alias("base"), tested_tokens(text).alias("tokens"))
    found = stored(found, "secret-spans")
    steps = accepted_steps(found.select(F.explode("tokens").alias("t")).select("t.*"), false_finds)
    return found.select(
        "doc_id", "base", F.sort_array(F.concat("base", random_spans(F.col("tokens"), F.col("base"), steps))).alias("spans")
    )


def redacted(docs: DataFrame, marker: str = "[SECRET]", false_finds: float = FALSE_FINDS) -> DataFrame:
    """``docs`` with every span replaced by ``marker``; spans that overlap or touch are replaced as one.

    All columns are returned; ``n_chars``, if there, is counted anew where a text changed. Rows are treated as by ``scan``,
    and a null text stays null. The spans are found twice, once for the counts and once for the texts.
    """
    rows = packed_rows(docs, text=docs["text"])
    text = F.coalesce(F.col("text"), F.lit(""))
    tokens = rows.select(F.explode(tested_tokens(text)).alias("t")).select("t.*")
    steps = accepted_steps(tokens, false_finds)
    both = F.struct(base_spans(text).alias("base"), tested_tokens(text).alias("tokens"))
    spans = _let(both, lambda s: F.sort_array(F.concat(s["base"], random_spans(s["tokens"], s["base"], steps))))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        out = F.when(s["start"] > a["at"], F.concat(a["out"], gap, F.lit(marker)))
        out = F.when(a["at"] < 0, F.concat(F.substring(F.col("text"), F.lit(1), s["start"]), F.lit(marker))).otherwise(
            F.coalesce(out, a["out"])
        )
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    first = F.struct(F.lit(-1).alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text")))
    clean = _let(spans, lambda s: F.when(F.size(s) > 0, F.aggregate(s, first, step, rest)).otherwise(F.col("text")))
    made = rows.select("row", clean.alias("clean"))
    changed = ~F.col("clean").eqNullSafe(F.col("row.text"))
    out = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == "text":
            value = F.col("clean")
        elif name == "n_chars":
            value = F.when(changed, F.length("clean").cast(docs.schema[name].dataType)).otherwise(value)
        out.append(value.alias(name))
    return made.select(*out)
