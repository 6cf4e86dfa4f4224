"""Quality rules (operator 5): a table of thresholds compiled into one Spark projection.

Each metric is written once for Spark and once for SQL engines with the same functions; the rules name a metric and the
range in which a document passes. The projection has built-in functions alone, and is evaluated once a row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.shared import fresh, readable, without

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in a is that it for was on as with be by this are at from der die und den von zu das mit des auf für ist im dem nicht ein eine als auch "
    "es an er hat aus bei le la les de un une et est que qui dans pour par sur plus avec il elle ne pas el los las en y una con para su se por del al lo no".split()
)
PUNCTUATION = ".,;:!?\"()[]\n\t\r"
SYMBOLS = "#$%&*|{}<>~^=\\@"


class Rule(NamedTuple):
    """A document passes if low <= metric <= high; None is no bound."""

    name: str
    metric: str
    low: float | None
    high: float | None
    #: The rule holds for texts of so many words at least, or lines where its metric is one of lines.
    least: int = 0


#: Limits after those of published rules for web text. Length alone doesn't make junk.
RULES = (
    Rule("too_short", "n_words", 1, None),
    Rule("too_long", "n_words", None, 1_000_000),
    Rule("word_length", "mean_word_length", 1, 14, 30),
    Rule("symbols", "symbol_ratio", None, 0.3, 5),
    Rule("capitals", "upper_ratio", None, 0.4, 30),
    Rule("repeated_words", "distinct_word_ratio", 0.05, None, 1),
    Rule("repeated_lines", "duplicate_line_ratio", None, 0.3, 4),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9, 4),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3, 4),
    Rule("stop_words", "stop_word_ratio", 0.02, None, 30),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def metrics(text: Column, lower: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Metrics by name, of a text and what measured() makes of it once: its lower case, words and lines."""
    n_words, n_lines, n_chars = F.size(words), F.size(lines), F.length(text)
    # Runs are replaced, which is cheaper than to count one by one what is frequent.
    upper = n_chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    letters = n_chars - F.length(F.regexp_replace(lower, "[a-z]+", ""))
    signs = F.length(F.regexp_replace(text, _class(PUNCTUATION + " ") + "+", ""))
    return {
        "n_words": n_words,
        "n_lines": n_lines,
        "mean_word_length": _ratio(signs, n_words),
        "symbol_ratio": _ratio(F.regexp_count(text, F.lit(_class(SYMBOLS))), n_words),
        "upper_ratio": _ratio(upper, letters),
        "distinct_word_ratio": _ratio(F.size(F.array_distinct(words)), n_words),
        "duplicate_line_ratio": _ratio(n_lines - F.size(F.array_distinct(lines)), n_lines),
        "bullet_line_ratio": _ratio(F.size(F.filter(lines, lambda s: F.substring(s, 1, 1).isin("-", "*", "•"))), n_lines),
        "ellipsis_line_ratio": _ratio(F.size(F.filter(lines, lambda s: s.endswith("...") | s.endswith("…"))), n_lines),
        "stop_word_ratio": _ratio(F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))), n_words),
    }


def _class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql(rules: tuple[Rule, ...] = RULES, table: str = "documents") -> str:
    """The kept rows of table as a query for DuckDB."""
    blanks = f"translate(t, {_literal(PUNCTUATION)}, {_literal(' ' * len(PUNCTUATION))})"
    exprs = {
        "n_words": "cast(len(ws) as int)",
        "n_lines": "cast(len(ls) as int)",
        "mean_word_length": "case when len(ws) > 0 then length(translate(plain, ' ', '')) / len(ws) else 0.0 end",
        "symbol_ratio": f"case when len(ws) > 0 then (length(t) - length(translate(t, {_literal(SYMBOLS)}, ''))) / len(ws) else 0.0 end",
        "upper_ratio": "case when length(t) > length(translate(lower(t), 'abcdefghijklmnopqrstuvwxyz', '')) then "
        "(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) / (length(t) - length(translate(lower(t), 'abcdefghijklmnopqrstuvwxyz', ''))) else 0.0 end",
        "distinct_word_ratio": "case when len(ws) > 0 then len(list_distinct(ws)) / len(ws) else 0.0 end",
        "duplicate_line_ratio": "case when len(ls) > 0 then (len(ls) - len(list_distinct(ls))) / len(ls) else 0.0 end",
        "bullet_line_ratio": "case when len(ls) > 0 then len(list_filter(ls, lambda s: s[1] in ('-', '*', '•'))) / len(ls) else 0.0 end",
        "ellipsis_line_ratio": "case when len(ls) > 0 then len(list_filter(ls, lambda s: suffix(s, '...') or suffix(s, '…'))) / len(ls) else 0.0 end",
        "stop_word_ratio": f"case when len(ws) > 0 then len(list_filter(ws, lambda w: w in ({', '.join(map(_literal, STOP_WORDS))}))) / len(ws) else 0.0 end",
    }
    fails = " or ".join(_failing_sql(r) for r in rules)
    return f"""
        with a as (select doc_id, coalesce(text, '') as t from {table}),
        b as (select *, {blanks} as plain from a),
        c as (select *, list_filter(string_split(lower(plain), ' '), lambda w: w <> '') as ws,
                     list_filter(string_split(t, chr(10)), lambda s: s <> '') as ls from b),
        d as (select doc_id, {', '.join(f'{e} as {k}' for k, e in exprs.items())} from c)
        select * from d where not ({fails})
    """


def _guard(rule: Rule) -> str:
    return f"{'n_lines' if '_line_' in rule.metric else 'n_words'} >= {rule.least}"


def _failing_sql(rule: Rule) -> str:
    sides = [f"{rule.metric} < {rule.low}"] * (rule.low is not None) + [f"{rule.metric} > {rule.high}"] * (rule.high is not None)
    return f"({_guard(rule)} and ({' or '.join(sides)}))"


def measured(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs with the metrics, and failed, the names of the rules that the document fails, in their order.

    A null text is measured as an empty one, which fails too_short; bytes that are no UTF-8 are measured as replacement
    characters. Ratios of nothing are 0. A rule isn't applied to texts of fewer words or lines than its least: of those
    in RULES, texts of fewer than 30 words can't fail word_length, capitals and stop_words, of fewer than 5 symbols, and
    of fewer than 4 lines the rules on lines; such shares mean nothing there, as in a title. Texts are measured whole.
    Columns named like a metric or failed, in any case of letters, are replaced. An empty table gives an empty table.
    """
    t, lower, words, lines = fresh(docs, "t", "lower", "words", "lines")
    found = metrics(F.col(t), F.col(lower), F.col(words), F.col(lines))
    keep = [c for c in docs.columns if c == text or c.lower() not in {*found, "failed"}]
    (box,) = fresh(docs, "box")

    def bound(rows: DataFrame, kept: list[str], **values: Column) -> DataFrame:
        # Through a generator, so that Catalyst evaluates what is made here once a row, however often it is used.
        made = F.explode(F.array(F.struct(*[e.alias(k) for k, e in values.items()])))
        rows = rows.select(*[F.col(f"`{c}`") for c in kept], made.alias(box))
        return rows.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"{box}.{k}").alias(k) for k in values])

    whole = F.coalesce(readable(F.col(f"`{text}`")), F.lit(""))
    rows = bound(docs, keep, **{t: whole, lower: F.lower(whole)})
    parts = F.filter(F.split(F.col(lower), _class(PUNCTUATION + " ")), lambda w: w != "")
    rows = bound(rows, [*keep, t, lower], **{words: parts, lines: F.filter(F.split(F.col(t), "\n"), lambda s: s != "")})
    boxed = rows.select(*[F.col(f"`{c}`") for c in keep], F.explode(F.array(F.struct(*[e.alias(k) for k, e in found.items()]))).alias(box))
    columns = [F.col(f"`{c}`") for c in keep] + [F.col(f"{box}.{k}").alias(k) for k in found]
    names = [F.when(F.expr(_boxed(_failing_sql(r), found, box)), F.lit(r.name)) for r in rules]
    return boxed.select(*columns, F.array_compact(F.array(*names)).alias("failed"))


def _boxed(condition: str, names: dict[str, Column], box: str) -> str:
    return " ".join(f"`{box}`.{w}" if w in names else w for w in condition.replace("(", "( ").replace(")", " )").split())


def select(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measured rows of docs that fail no rule. An empty table gives an empty table; repeated rows share their fate."""
    return measured(docs, text, rules).where(F.size("failed") == 0).transform(lambda x: without(x, "failed"))
