r"""Quality rules: a threshold table compiled into one projection, without user functions.

A rule bounds a ratio of two measures of a text: ``least <= 1000 * part / whole <= most``.
``compile_rules`` turns the table into one column with the names of the rules a text
breaks, in whole numbers only, so every engine gives the same verdict. The measures
are SQL expressions over the words and lines of the text; nothing leaves the row and
nothing is shuffled.

Repeated windows: the three-word windows of a text are sorted as (31-bit hash, place)
in one long each. Neighbours with the same hash are only then compared word by word, so
the count is exact and the usual text pays for one sort of longs.

Null text: no words, no lines. Empty and blank texts: the same. Texts under ``MIN_WORDS``
words fail the base rules. Rows are judged one by one: repeated rows and ties get the
same verdict each. Very long texts are sorted within their row. Extra columns are carried
(``keep_good``) or ignored (``measures``, ``verdicts``); no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.llm.names import column, free

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
LOW31, LOW32 = "2147483647L", "4294967295L"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = ("the be to of and that have with in is it for on as was are this by at from "
              "der die das und ist nicht ein eine zu den von mit auf als für im sich dem "
              "le la les de des et un une en que qui dans pour par du est au sur "
              "el los las y del se con por una su para es lo como").split()


@dataclass(frozen=True)
class Rule:
    """``least <= 1000 * part / whole <= most``; a bound of None does not apply."""
    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


# The base rules decide ``base_failed``; the others refine the verdict.
BASE = (Rule("few_words", "n_words", "1", least=1000 * MIN_WORDS),
        Rule("repeated_windows", "n_repeat_words", "n_words", most=500))
RULES = (Rule("word_length", "word_chars", "n_words", least=2500, most=15000),
         Rule("symbols", "n_symbols", "n_words", most=100),
         Rule("stop_words", "n_stop_words", "n_words", least=10),
         Rule("repeated_lines", "n_dup_lines", "n_lines", most=300),
         Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900),
         Rule("cut_lines", "n_cut_lines", "n_lines", most=300))


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _repeat_words(w: str) -> str:
    """SQL: words of the array ``w`` inside a three-word window that occurs twice or more."""
    keys = (f"sort_array(transform(slice({w}, 1, greatest(size({w}) - 2, 0)), (x, i) -> "
            f"shiftleft(xxhash64(x, get({w}, i + 1), get({w}, i + 2)) & {LOW31}, 32) | i))")
    place = f"cast(v & {LOW32} as int)"
    tied = (f"sort_array(transform(filter(k, (v, j) -> (get(k, j - 1) ^ v) <= {LOW32} or (get(k, j + 1) ^ v) <= {LOW32}), "
            f"v -> named_struct('a', get({w}, {place}), 'b', get({w}, {place} + 1), 'c', get({w}, {place} + 2), 'i', {place})))")

    def same(j: str) -> str:
        return " and ".join(f"get(s, {j}).{f} = v.{f}" for f in "abc")
    places = f"sort_array(transform(filter(s, (v, j) -> ({same('j - 1')}) or ({same('j + 1')})), v -> v.i))"
    covered = (f"aggregate({places}, named_struct('last', -3, 'n', 0L), (c, i) -> "
               "named_struct('last', i, 'n', c.n + least(3, i - c.last)), c -> c.n)")
    return f"transform(array({keys}), k -> transform(array({tied}), s -> {covered})[0])[0]"


def _measures(text: str, words: str, lines: str) -> dict[str, str]:
    """SQL of each measure over the columns text, its words and its lines with a word."""
    stop = _quoted(STOP_WORDS + [w.capitalize() for w in STOP_WORDS])
    return {
        "n_words": f"cast(size({words}) as bigint)",
        "word_chars": f"cast(length(translate({text}, ' \\t\\n\\u000B\\u000C\\r', '')) as bigint)",
        "n_symbols": f"cast(length({text}) - length(translate({text}, '{SYMBOLS}', '')) as bigint)",
        "n_stop_words": f"cast(size(filter({words}, x -> x in ({stop}))) as bigint)",
        "n_lines": f"cast(size({lines}) as bigint)",
        "n_dup_lines": f"cast(size({lines}) - size(array_distinct({lines})) as bigint)",
        "n_bullet_lines": f"cast(size(filter({lines}, x -> x rlike r'^[\\x20\\x09-\\x0D]*[-*•]')) as bigint)",
        "n_cut_lines": f"cast(size(filter({lines}, x -> x rlike r'(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*\\z')) as bigint)",
        "n_repeat_words": _repeat_words(words),
    }


def compile_rules(rules: tuple[Rule, ...], measured: str = "") -> Column:
    """Names of the broken rules, comma-joined in table order; ``measured`` is the struct
    column that holds the measures (none: plain columns). A whole of zero breaks no bound
    but a least one."""
    def value(name: str) -> str:
        return name if name.isdigit() else f"{measured}.{name}" if measured else name
    broken = []
    for r in rules:
        part, whole = f"1000L * {value(r.part)}", value(r.whole)
        tests = [f"{part} < {r.least}L * {whole}"] * (r.least is not None) + [f"{part} > {r.most}L * {whole}"] * (r.most is not None)
        broken.append(f"if({' or '.join(tests)}, '{r.name}', null)")
    return F.expr(f"concat_ws(',', {', '.join(broken)})")


def _measured(docs: DataFrame, text_col: str, keep: list[str]) -> tuple[DataFrame, str]:
    """``keep`` columns of ``docs`` with a struct of all measures; and its name."""
    text, words, lines, found = free(docs, "text_", "words_", "lines_", "measures_")
    quoted = [column(c) for c in keep]
    split = docs.select(*quoted, F.coalesce(column(text_col).cast("string"), F.lit("")).alias(text))
    split = split.select("*", F.expr(f"regexp_extract_all({text}, r'{WORD}', 0)").alias(words),
                         F.expr(f"filter(split({text}, '\\n'), x -> x rlike r'[^\\x20\\x09-\\x0D]')").alias(lines))
    each = [F.expr(sql).alias(name) for name, sql in _measures(text, words, lines).items()]
    return split.select(*quoted, F.struct(*each).alias(found)), found


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measures of its text; one row per row of ``docs``."""
    measured, found = _measured(docs, text_col, [id_col])
    return measured.select(column(id_col).alias("doc_id"), f"{found}.*")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with ``broken`` (names of broken rules), ``base_failed`` and ``kept``."""
    out = measures(docs, id_col, text_col)
    out = out.withColumn("base_failed", compile_rules(BASE) != "").withColumn("broken", compile_rules(BASE + tuple(rules)))
    return out.withColumn("kept", F.col("broken") == "")


def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with their columns as they are."""
    measured, found = _measured(docs, text_col, docs.columns)
    return measured.filter(compile_rules(BASE + tuple(rules), found) == "").select(*[column(c) for c in docs.columns])
