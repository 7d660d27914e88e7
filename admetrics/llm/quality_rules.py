"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Words are maximal runs without the white space of `[\\x20\\x09-\\x0D]`; a null text has none. Every measure is taken
from the whole text inside its own row, so nothing is shuffled and no row depends on another. Word length and stop words are
measures of Latin scripts; texts in Cyrillic, Chinese and other scripts are judged by the other rules.

Defined cases: a null, empty or blank text has zero words and fails the base rules. Repeated rows are judged alike.
Columns of the input other than the text are carried along; a measure whose name clashes with one of them
takes its place in `judge`. An empty table gives an empty table. Equal windows of words are found by their
64-bit hashes within one text, so a text of a million words errs with a chance below 1e-7.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 5

#: Frequent function words of languages in Latin letters: fixed values. English, German, French, Spanish, Italian, Portuguese, Dutch,
#: Polish, Swedish, Turkish, Indonesian, Czech, Finnish and Hungarian.
STOP_WORDS = (
    "the of and to in a is that it for was on as with be by this are at from or an "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de des et en un une du que qui dans pour est sur par pas au avec "
    "el los las y que del se por con para una no su lo como es al "
    "il di che è per non sono gli della "
    "o da do em um não uma os ao "
    "het een van te dat voor zijn niet "
    "i w z na się nie jest że jak "
    "och att det som på är av för med till inte "
    "ve bir bu için ile çok "
    "yang dan dengan untuk ini itu dari tidak "
    "v si že je jsou "
    "ja on ei oli että "
    "az és hogy nem egy"
).split()

#: Letters and marks of other scripts: what lies below is taken out first, then all that is no letter.
_BELOW, _NO_LETTER, _OTHER = r"[\x{00}-\x{036F}]+", r"[^\p{L}\p{M}]+", 0.5


@dataclass(frozen=True)
class Rule:
    """A text fails the rule when its measure lies outside [least, most] and it has at least `from_words` words.

    A rule of Latin scripts judges no text of which more than half the word characters are letters of other scripts.
    """

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0
    latin: bool = False


#: Rules of the contract that decide before the others.
BASE = (Rule("too_few_words", "n_words", least=10), Rule("repetitive", "repeat_percent", most=20))

#: Production thresholds.
RULES = (
    Rule("word_length", "mean_word_chars", least=2.0, most=16.0, latin=True),
    Rule("symbols", "symbols_per_word", most=0.2),
    Rule("stop_words", "stop_word_ratio", least=0.05, from_words=30, latin=True),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def let(value: Column, body) -> Column:
    """Evaluates `value` once per row and hands it to `body` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once."""

    def at(items, i):
        return F.get(items, i)["h"]

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    twice = let(
        ordered,
        lambda s: F.filter(
            s, lambda e, i: e["h"].eqNullSafe(at(s, i + 1)) | ((i > 0) & e["h"].eqNullSafe(at(s, F.greatest(i - 1, F.lit(0)))))
        ),
    )
    starts = F.sort_array(F.transform(twice, lambda e: e["at"]))
    steps = let(
        starts,
        lambda s: F.transform(s, lambda p, i: F.least(F.lit(_WINDOW), F.coalesce(F.get(s, i + 1) - p, F.lit(_WINDOW)))),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of five words found twice or more in the text."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (_WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(_WINDOW))))
    return F.when(
        F.size(words) > _WINDOW,
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _repeated(h)).otherwise(0)),
    ).otherwise(0)


def measures(text: Column) -> Column:
    """One struct with all counts of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, f"{_SPACE}+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_word = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
        ),
    )
    by_line = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    return F.struct(
        by_word.alias("words"),
        by_line.alias("lines"),
        F.length(F.translate(text, _SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace(F.regexp_replace(text, _BELOW, ""), _NO_LETTER, "")).cast("bigint").alias("n_other_letters"),
    )


def named(found: Column) -> dict[str, Column]:
    """The counts of `measures` and the ratios that rules may name."""
    counts = {c: found["words"][c] for c in ("n_words", "n_stop_words", "n_repeat_words")}
    counts |= {c: found["lines"][c] for c in ("n_lines", "n_dup_lines")}
    counts |= {c: found[c] for c in ("word_chars", "n_symbols", "n_other_letters")}

    def ratio(part, whole):
        return F.when(counts[whole] > 0, counts[part] / counts[whole]).otherwise(F.lit(0.0))

    ratios = {
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "other_letter_ratio": ratio("n_other_letters", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_percent": F.when(counts["n_words"] > 0, 100 * counts["n_repeat_words"] / counts["n_words"]).otherwise(F.lit(0.0)),
    }
    return counts | ratios


def fails(rule: Rule, values: dict[str, Column]) -> Column:
    """True for a text outside the rule."""
    value, outside = values[rule.measure], F.lit(False)
    if rule.least is not None:
        outside = outside | (value < rule.least)
    if rule.most is not None:
        outside = outside | (value > rule.most)
    if rule.latin:
        outside = outside & (values["other_letter_ratio"] <= _OTHER)
    return outside & (values["n_words"] >= rule.from_words)


def any_of(rules, values: dict[str, Column]) -> Column:
    verdict = F.lit(False)
    for rule in rules:
        verdict = verdict | fails(rule, values)
    return verdict


def judge(df: DataFrame, text="text", base=BASE, rules=RULES) -> DataFrame:
    """The input with its counts and ratios, `base_failed`, `failed_rules` (names) and `kept`."""
    bag = "_measures"
    while bag in df.columns:
        bag += "_"
    values = named(F.col(bag))
    names = F.array(*[F.when(fails(r, values), F.lit(r.name)) for r in (*base, *rules)])
    verdicts = {
        "base_failed": any_of(base, values),
        "failed_rules": F.array_compact(names),
        "kept": ~any_of((*base, *rules), values),
    }
    return df.withColumn(bag, measures(F.col(f"`{text}`"))).withColumns(values | verdicts).drop(bag)


def keep_good(docs: DataFrame, text="text", base=BASE, rules=RULES) -> DataFrame:
    """The rows that pass all rules, with the columns they came with.

    The verdict is one expression that takes the measures once, so a filter on it does not count a text again for every rule.
    """
    verdict = let(measures(F.col(f"`{text}`")), lambda found: ~any_of((*base, *rules), named(found)))
    return docs.where(verdict)
