"""Per-document repair rules: pure text -> text Columns, kept in an ordered rule book."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions.text import let, lines, quote, strip, sub, unlines
from corpusloom.rules import HS, WS

Rule = Callable[[Column], Column]
RuleBook = dict[str, list[tuple[str, Rule]]]


def space_after_period(text: Column) -> Column:
    return sub(text, r"\.(?=[A-Z])", ". ")


def merge_split_headings(text: Column, pairs) -> Column:
    def one(t: Column, pair) -> Column:
        first, second = pair
        pattern = (
            rf"(##{WS}+\*\*{quote(first)})(\*\*){WS}*\n[ \t]*\n##{WS}+\*\*({quote(second)})\*\*"
        )
        return sub(t, pattern, "$1 $3$2")

    return reduce(one, pairs, text)


def demote_subnumbering(text: Column) -> Column:
    return sub(text, r"(?md)^## \*\*(\d+\.\d+)", "### **$1")


def _after_match(text: Column, pattern: str, rewrite: Rule) -> Column:
    """Rewrite only what follows the first match; unmatched text passes through."""

    def at(t: Column, hit: Column) -> Column:
        end = F.regexp_instr(t, F.lit(pattern)) - 1 + F.length(hit)
        tail = rewrite(F.substr(t, end + F.lit(1)))
        return F.when(hit.isNull(), t).otherwise(F.concat(F.left(t, end), tail))

    return let(text, lambda t: let(F.regexp_substr(t, F.lit(pattern)), lambda hit: at(t, hit)))


def demote_faq(text: Column, wrapper: str = rules.FAQ_WRAPPER) -> Column:
    pattern = rf"## \*\*[^*]*{quote(wrapper)}[^*]*\*\*"
    return _after_match(text, pattern, lambda tail: sub(tail, r"(?md)^## \*\*", "### **"))


def demote_under_wrapper(text: Column, wrapper: str = rules.PROBLEM_WRAPPER) -> Column:
    """Demote bold H2s after the wrapper heading, up to the first boundary heading.

    A boundary is a bold H2 that is numbered, ends in a colon or question mark,
    or is followed (blank lines apart) by a numbered bold H1 or H2.
    """
    end = rf"\*\*{HS}*$"
    numbered = r"\d+\.[^*\n]*"
    stop = (
        rf"(?md)^{HS}*## \*\*(?:{numbered}|[^*\n]*[:?]{HS}*){end}"
        rf"|^{HS}*## \*\*[^*\n]+{end}(?:\n{HS}*+)++#{{1,2}} \*\*{numbered}{end}"
    )
    heading = rf"(?md)^({HS}*)## (\*\*[^*\n]+{end})"

    def demote(tail: Column) -> Column:
        def cut(t: Column) -> Column:
            at = F.regexp_instr(t, F.lit(stop))
            size = F.when(at > 0, at - 1).otherwise(F.length(t))
            return F.concat(sub(F.left(t, size), heading, "$1### $2"), F.substr(t, size + F.lit(1)))

        return let(tail, cut)

    return _after_match(text, rf"(?md)^{HS}*## \*\*{quote(wrapper)}{end}", demote)


def restore_ligatures(text: Column, table=rules.LIGATURES) -> Column:
    return reduce(lambda t, r: sub(t, rf"\b{r[0]}\b", r[1]), table, text)


_PIC_START = r"\*\*----- Start of picture text -----\*\*<br>\n"
_PIC_END = r"\*\*----- End of picture text -----\*\*<br>\n"


def drop_picture_block(text: Column, fingerprint: str) -> Column:
    return sub(text, rf"(?md)^{_PIC_START}[^\n]*?{quote(fingerprint)}[^\n]*?{_PIC_END}", "")


def replace_picture_blocks(md: Column, files: Column, folder: Column) -> tuple[Column, Column]:
    """(nth picture block replaced by the nth image link, number of blocks)."""
    blocks = F.split(md, rf"(?md)^{_PIC_START}[^\n]*{_PIC_END}", -1)

    def link(i: Column, n: Column) -> Column:
        file = F.try_element_at(files, i + 1)
        alt = sub(file, r"\.[^.]*$", "")
        image = F.concat(F.lit("!["), alt, F.lit("]("), folder, F.lit("/"), file, F.lit(")\n\n"))
        return F.when((i < n) & file.isNotNull(), image).otherwise("")

    woven = let(
        blocks,
        lambda parts: F.transform(parts, lambda p, i: F.concat(p, link(i, F.size(parts) - 1))),
    )
    return F.array_join(woven, ""), F.size(blocks) - 1


def fix_table_cells(text: Column) -> Column:
    """Fill empty cells and escape `$m` in the rows of real tables.

    Each line becomes one letter: S separator, D data row, O other. Rows that
    touch a separator are then marked on that string with two patterns, which
    keeps the pass linear in the number of lines.
    """
    separator = rf"^\|[{WS[1:-1]}\-:|]+\|\z"

    def letter(line: Column) -> Column:
        s = strip(line)
        pipes = F.regexp_count(s, F.lit(r"\|"))
        sep = s.rlike(separator)
        data = s.startswith("|") & s.endswith("|") & (pipes >= 4) & ~sep
        return F.when(sep & (pipes >= 3), "S").when(data, "D").otherwise("O")

    def fixed(line: Column) -> Column:
        return sub(sub(line, r"\|(?=\|)", "|-"), r"(?<!\\)\$m", r"\\\$m")

    def rewrite(rows: Column) -> Column:
        shape = F.concat(F.lit("O"), F.array_join(F.transform(rows, letter), ""))
        marked = sub(sub(shape, r"(?<=S)D|\GD", "P"), r"[DP](?=S)", "P")
        flags = F.slice(F.split(F.substr(marked, F.lit(2)), ""), F.lit(1), F.size(rows))
        return F.zip_with(rows, flags, lambda r, f: F.when(f == "P", fixed(r)).otherwise(r))

    return let(
        text, lambda t: F.when(t.contains("|"), unlines(let(lines(t), rewrite))).otherwise(t)
    )


def drop_running_label(text: Column, label: str) -> Column:
    return sub(text, rf"\n\n\*\*{quote(label)}\*\*\n\n", "\n\n")


def promote_bold_heading(text: Column, heading: str) -> Column:
    """A bold-only line becomes an H2; anchored, so a second pass changes nothing."""
    return sub(text, rf"(?md)^\*\*({quote(heading)})\*\*", "## **$1**")


def drop_duplicate_header(text: Column, doc_type: str = rules.DUPLICATE_HEADER) -> Column:
    return sub(text, rf"\nDocument Type \*\*{quote(doc_type)}\*\*\n\n", "\n\n")


def drop_orphan_heading(text: Column, paragraph: str = rules.ORPHAN_PARAGRAPH) -> Column:
    return sub(text, rf"(?md)^##[ \t]*\n\n({quote(paragraph)})", "$1")


# --- per-document chains ----------------------------------------------------


def chain(*steps: Rule) -> Rule:
    return lambda text: reduce(lambda t, step: step(t), steps, text)


def merge_policy_headings(text: Column) -> Column:
    return space_after_period(merge_split_headings(text, rules.SPLIT_HEADINGS))


def labelled_overview(label: str, promoted=()) -> Rule:
    return chain(
        lambda t: drop_running_label(t, label),
        *[lambda t, h=h: promote_bold_heading(t, h) for h in promoted],
        space_after_period,
    )


def summary_report(text: Column) -> Column:
    out = drop_orphan_heading(text)
    return reduce(drop_picture_block, rules.DECORATIVE_PICTURES, out)


def default_rule_book() -> RuleBook:
    first, second, third = rules.RUNNING_LABELS
    return {
        "pdf-policy-overview.md": [
            ("merge wrapped headings, space sentences", merge_policy_headings),
            ("fill empty table cells, escape unit", fix_table_cells),
            ("drop running label, promote headings",
             labelled_overview(first, rules.PROMOTED_HEADINGS)),
            ("drop running label", labelled_overview(second)),
            ("drop running label", labelled_overview(third)),
            ("nest headings under their wrapper", demote_under_wrapper),
            ("nest questions under their wrapper", demote_faq),
            ("nest sub-numbered headings", demote_subnumbering),
        ],
        "pdf-policy-addendum.md": [
            ("drop duplicate header, space sentences",
             chain(drop_duplicate_header, space_after_period)),
            ("fill empty table cells", fix_table_cells),
        ],
        "pdf-default.md": [
            ("restore dropped ligatures", restore_ligatures),
            ("drop orphan heading and decorative pictures", summary_report),
        ],
    }


def add_rule(book: RuleBook, key: str, description: str, rule: Rule) -> RuleBook:
    """A new book with one more rule at the end of a key."""
    if not re.fullmatch(r"\S.*", description or ""):
        raise ValueError("a rule needs a description")
    return {**book, key: [*book.get(key, []), (description, rule)]}


class PythonRule:
    """A rule from a plain function of one text; a null stays null.

    For what columns can't express. The function must be pure, as Spark may run it
    again. Texts go to Python a hundred rows at a time, so what a worker holds
    doesn't grow with the table, as Arrow batches of ten thousand texts do.
    """

    def __init__(self, fn: Callable[[str], str]):
        self.fn = fn

    def __call__(self, text: Column) -> Column:
        fn = self.fn
        run = F.udf(lambda t: None if t is None else fn(t), "string", useArrow=False)
        return run(text)


def repaired(rows: DataFrame, key: str, text: str, book: RuleBook | None = None) -> DataFrame:
    """The rows with `text` repaired by the rules of their key, Python rules too.

    Runs of column rules are one projection each; a Python rule gets the texts of
    its key alone, and nulls in place of the others.
    """
    book = default_rule_book() if book is None else book
    for name, entries in book.items():
        mine = F.col(key) == name
        for in_python, run in groupby((rule for _, rule in entries), lambda rule: isinstance(rule, PythonRule)):
            for rule in run if in_python else [chain(*run)]:
                new = rule(F.when(mine, F.col(text)))
                rows = rows.withColumn(text, F.when(mine, new).otherwise(F.col(text)))
    return rows


def rule_faults(rows: DataFrame, key: str, text: str, book: RuleBook | None = None) -> DataFrame:
    """Rules of a book that break their promises over the rows of their key.

    (key, ord, description, rows, changed, not_repeatable, not_idempotent): how many
    rows a rule looked at and changed, how many came out otherwise when it was built
    and run a second time, and how many it changes again in its own result. Each
    rule gets the result of those before it, as in `apply_rules`. One pass over the
    rows for a key, and one count a rule is all that is shuffled.
    """
    book = default_rule_book() if book is None else book
    out = None
    for name, entries in book.items():
        step = rows.filter(F.col(key) == name).select(F.col(text).alias("t0"))
        for i, (_, rule) in enumerate(entries):
            t = F.col(f"t{i}")
            step = step.withColumns({f"t{i + 1}": rule(t), f"again{i}": rule(t)})
            step = step.withColumn(f"twice{i}", rule(F.col(f"t{i + 1}")))
        counts = [
            F.struct(
                F.lit(name).alias("key"), F.lit(i).alias("ord"), F.lit(description).alias("description"),
                F.count("*").alias("rows"),
                F.count_if(~F.col(f"t{i}").eqNullSafe(F.col(f"t{i + 1}"))).alias("changed"),
                F.count_if(~F.col(f"t{i + 1}").eqNullSafe(F.col(f"again{i}"))).alias("not_repeatable"),
                F.count_if(~F.col(f"t{i + 1}").eqNullSafe(F.col(f"twice{i}"))).alias("not_idempotent"),
            )
            for i, (description, _) in enumerate(entries)
        ]
        if not counts:
            continue
        found = step.agg(F.array(*counts).alias("r")).select(F.inline("r"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("the book has no rules")
    return out


def apply_rules(key: Column, text: Column, book: RuleBook | None = None) -> Column:
    """Run the rules registered for each row's key, in order; other keys pass through.

    Column rules only: `repaired` takes a book that holds Python rules.
    """
    book = default_rule_book() if book is None else book
    if any(isinstance(rule, PythonRule) for entries in book.values() for _, rule in entries):
        raise ValueError("the book holds Python rules: use repaired")

    def pick(t: Column) -> Column:
        out = F.when(F.lit(False), t)
        for name, entries in book.items():
            out = out.when(key == name, chain(*[rule for _, rule in entries])(t))
        return out.otherwise(t)

    return let(text, pick)
