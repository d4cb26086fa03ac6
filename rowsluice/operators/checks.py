"""CHECK constraints as boolean columns with SQL's three-valued logic.

A CHECK arrives as the text a database renders. It is respelled in Python's
expression grammar with every name and literal replaced by a placeholder, so
``ast.parse`` does the parsing; the tree then maps one to one onto Column
operators and Catalyst evaluates it inside the scan stage. Texts with anything
else in them (functions, arithmetic, LIKE, unresolvable names) are reported as
skipped, never guessed at.
"""

from __future__ import annotations

import ast
import operator
import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsluice.functions.cells import Cell, number_in_text
from rowsluice.functions.text import case_key, strip_space


class UnsupportedCheck(ValueError):
    """The CHECK uses syntax this package leaves to the target to enforce."""


# ---- spelling -------------------------------------------------------------

STRING_TEXT = {
    "postgres": r"'(?:[^']|'')*'",
    "mysql": r"'(?:[^'\\]|''|\\.)*'",
}
QUOTED_NAME = r'`(?:[^`]|``)*`|"(?:[^"]|"")*"'
NUMBER = r"(?:[0-9]|\.[0-9])(?:[eE][+-]?|[0-9.])*"
WORD = r"[A-Za-z_][A-Za-z0-9_$]*"
SYMBOL = r"<=|>=|<>|!=|::|[-+*/%(),=<>\[\]]"
BLANK = r"[ \t\r\n]+"

# CHECK words and symbols and how Python spells them.
PYTHON_WORDS = {
    "AND": "and", "OR": "or", "NOT": "not", "IN": "in", "IS": "is",
    "NULL": "None", "TRUE": "True", "FALSE": "False",
    "BETWEEN": "in", "ANY": "ANY", "ARRAY": "ARRAY", "LIKE": "LIKE",
}
PYTHON_SYMBOLS = {"=": "==", "<>": "!="}


def _lexemes(dialect: str) -> re.Pattern:
    text = STRING_TEXT[dialect]
    return re.compile(
        rf"(?P<string>(?:_[A-Za-z0-9_$]*(?='))?{text})|(?P<quoted>{QUOTED_NAME})"
        rf"|(?P<number>{NUMBER})|(?P<word>{WORD})|(?P<symbol>{SYMBOL})|(?P<blank>{BLANK})",
        re.DOTALL,
    )


LEXEMES = {dialect: _lexemes(dialect) for dialect in STRING_TEXT}

# A cast is "::" and type words (placeholders by then), a modifier, array marks.
CAST = re.compile(r"::\s*n\d+(?:\s+n\d+)*(?:\s*\([^)]*\))?(?:\s*\[\s*\])*")
ANY_ARRAY = re.compile(r"==\s*ANY\s*((?:\(\s*)*)ARRAY\s*\[")


@dataclass(frozen=True)
class Leaf:
    """What a placeholder stands for: a column name or a literal."""

    kind: str  # name | text | number
    value: str | int | float


def _unquoted_string(lexeme: str, dialect: str) -> str:
    body = lexeme[lexeme.index("'") + 1 : -1]
    if dialect == "mysql":
        return re.sub(r"''|\\(.)", lambda m: m.group(1) or "'", body, flags=re.DOTALL)
    return body.replace("''", "'")


def _number(lexeme: str) -> int | float:
    try:
        value = float(lexeme)
    except ValueError:
        raise UnsupportedCheck(f"bad number {lexeme}") from None
    if value == float("inf"):
        raise UnsupportedCheck(f"number out of range: {lexeme}")
    return int(lexeme) if lexeme.isdigit() and len(lexeme) < 19 else value


def normalize_check(definition: str) -> str:
    """Strip ``CHECK`` and ``NOT VALID`` around the boolean expression."""
    bare = re.sub(r"(?is)^check", "", definition.strip()).strip()
    return re.sub(r"(?is)not valid$", "", bare).strip()


def _lex(expr: str, dialect: str) -> list[re.Match]:
    found = list(LEXEMES[dialect].finditer(expr))
    if sum(m.end() - m.start() for m in found) != len(expr):
        raise UnsupportedCheck("unsupported character or open quote")
    return found


def parse_check(expr: str, dialect: str = "postgres") -> tuple[ast.expr, dict[str, Leaf]]:
    """The expression tree of a CHECK and the leaves its placeholders stand for.

    Pure Python, so that it can also classify a catalog of CHECKs in tasks.
    """
    leaves: dict[str, Leaf] = {}

    def placeholder(prefix: str, leaf: Leaf) -> str:
        name = f"{prefix}{len(leaves)}"
        leaves[name] = leaf
        return name

    pieces: list[str] = []
    range_open = [False]  # per parenthesis level: a BETWEEN still waits for its AND
    for match in _lex(expr, dialect):
        lexeme = match.group()
        if match.lastgroup == "string":
            pieces.append(placeholder("k", Leaf("text", _unquoted_string(lexeme, dialect))))
        elif match.lastgroup == "number":
            pieces.append(placeholder("k", Leaf("number", _number(lexeme))))
        elif match.lastgroup == "quoted":
            mark = lexeme[0]
            bare = lexeme[1:-1].replace(mark * 2, mark)
            pieces.append(placeholder("q", Leaf("name", bare.lower())))
        elif match.lastgroup == "word":
            keyword = lexeme.upper()
            if keyword == "AND" and range_open[-1]:
                # "lo AND hi" of a BETWEEN becomes one operand pair: "@" binds
                # tighter than any comparison and has no other use here.
                range_open[-1] = False
                pieces.append("@")
            elif keyword in PYTHON_WORDS:
                range_open[-1] = range_open[-1] or keyword == "BETWEEN"
                pieces.append(PYTHON_WORDS[keyword])
                if keyword == "BETWEEN":
                    pieces.append("RANGE @")
            else:
                pieces.append(placeholder("n", Leaf("name", lexeme.lower())))
        elif match.lastgroup == "symbol":
            if lexeme in "([":
                range_open.append(False)
            elif lexeme in ")]" and len(range_open) > 1:
                range_open.pop()
            pieces.append(PYTHON_SYMBOLS.get(lexeme, lexeme))
    source = ANY_ARRAY.sub(r"in \1[", CAST.sub(" ", " ".join(pieces)))
    try:
        tree = ast.parse(source.strip(), mode="eval").body
    except (SyntaxError, RecursionError, MemoryError, ValueError):
        raise UnsupportedCheck("unsupported syntax") from None
    _Support(leaves).visit(tree)
    return tree, leaves


class _Support(ast.NodeVisitor):
    """Refuses every construct outside the supported CHECK subset."""

    COMPARISONS = (ast.Eq, ast.NotEq, ast.Lt, ast.LtE, ast.Gt, ast.GtE)

    def __init__(self, leaves: dict[str, Leaf]):
        self.leaves = leaves

    def generic_visit(self, node):
        raise UnsupportedCheck(f"unsupported syntax: {type(node).__name__}")

    def visit_BoolOp(self, node):
        for value in node.values:
            self.visit(value)

    def visit_UnaryOp(self, node):
        if isinstance(node.op, ast.Not):
            self.visit(node.operand)
        elif not (isinstance(node.op, ast.USub) and self._is_number(node.operand)):
            raise UnsupportedCheck("unsupported unary operator")

    def _is_number(self, node) -> bool:
        leaf = self.leaves.get(node.id) if isinstance(node, ast.Name) else None
        return leaf is not None and leaf.kind == "number"

    def visit_Compare(self, node):
        if len(node.ops) != 1:
            raise UnsupportedCheck("chained comparison")
        self.visit(node.left)
        op, right = node.ops[0], node.comparators[0]
        if isinstance(op, (ast.Is, ast.IsNot)):
            if not (isinstance(right, ast.Constant) and right.value is None):
                raise UnsupportedCheck("IS is supported for NULL only")
        elif isinstance(op, (ast.In, ast.NotIn)):
            members = range_ends(right) or list_items(right)
            for member in members:
                if isinstance(member, (ast.Compare, ast.BoolOp)) and not range_ends(right):
                    raise UnsupportedCheck("unsupported list item")
                self.visit(member)
        else:
            self.visit(right)

    def visit_Name(self, node):
        if node.id not in self.leaves:
            raise UnsupportedCheck(f"unexpected word {node.id}")

    def visit_Constant(self, node):
        pass


def range_ends(node: ast.expr) -> tuple[ast.expr, ast.expr] | None:
    """(lo, hi) where the node is the operand pair of a BETWEEN."""
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.MatMult):
        inner = node.left
        if (
            isinstance(inner, ast.BinOp)
            and isinstance(inner.op, ast.MatMult)
            and isinstance(inner.left, ast.Name)
            and inner.left.id == "RANGE"
        ):
            return inner.right, node.right
    return None


def list_items(node: ast.expr) -> list[ast.expr]:
    return node.elts if isinstance(node, (ast.List, ast.Tuple)) else [node]


# ---- three-valued comparison ---------------------------------------------

OPERATORS = {
    ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt,
    ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge,
}


def unknown() -> Column:
    return F.lit(None).cast("boolean")


def compare_text(op, left: Column, right: Column) -> Column:
    """Byte order; texts that differ by case only are UNKNOWN (collation decides)."""
    return F.when((left == right) | (case_key(left) != case_key(right)), op(left, right))


def as_number(cell: Cell) -> Column | None:
    """Numeric view: numbers, booleans as 1 and 0, texts that spell a number."""
    views = [v for v in (cell.number(),) if v is not None]
    text = cell.text()
    if text is not None:
        views.append(number_in_text(text))
    return F.coalesce(*views) if len(views) > 1 else (views[0] if views else None)


def compare(op, left: Cell, right: Cell) -> Column:
    """TRUE, FALSE or NULL (UNKNOWN) for two cells of any kinds."""
    families = {left.family, right.family}
    if families & {"null", "nested"}:
        return unknown()
    if "time" in families:
        moments = [_moment(left), _moment(right)]
        return op(*moments) if all(m is not None for m in moments) else unknown()
    texts = (left.text(), right.text())
    if families == {"text"}:
        return compare_text(op, *texts)
    numbers = (as_number(left), as_number(right))
    by_number = op(*numbers) if all(n is not None for n in numbers) else unknown()
    if all(t is not None for t in texts):
        both_text = texts[0].isNotNull() & texts[1].isNotNull()
        return F.when(both_text, compare_text(op, *texts)).otherwise(by_number)
    return by_number


def _moment(cell: Cell) -> Column | None:
    if cell.family == "time":
        return cell.col.cast("timestamp_ntz")
    text = cell.text()
    return None if text is None else strip_space(text).try_cast("timestamp_ntz")


def truth(cell: Cell) -> Column:
    """A cell read as a condition: booleans, numbers other than 0, else UNKNOWN."""
    if cell.family == "boolean":
        return cell.col
    if cell.family in ("integer", "number"):
        return cell.col != 0
    if cell.raw:
        return cell.number() != 0
    return unknown()


# ---- translation ----------------------------------------------------------


@dataclass(frozen=True)
class CompiledCheck:
    name: str
    expr: str
    columns: tuple[str, ...]
    holds: Column  # nullable: NULL (UNKNOWN) passes

    @property
    def fails(self) -> Column:
        """TRUE only where the CHECK is definitely violated."""
        return ~self.holds


class _Translation:
    def __init__(self, leaves: dict[str, Leaf], cells: dict[str, Cell]):
        self.leaves, self.cells = leaves, cells

    def cell(self, node: ast.expr) -> Cell:
        if isinstance(node, ast.Name):
            leaf = self.leaves[node.id]
            if leaf.kind == "name":
                if leaf.value not in self.cells:
                    raise UnsupportedCheck(f"unknown name {leaf.value}")
                return self.cells[leaf.value]
            return Cell("", "text" if leaf.kind == "text" else "number", F.lit(leaf.value))
        if isinstance(node, ast.Constant):
            return Cell("", "null" if node.value is None else "boolean", F.lit(node.value))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return Cell("", "number", F.lit(-self.leaves[node.operand.id].value))
        return Cell("", "boolean", self.condition(node))

    def condition(self, node: ast.expr) -> Column:
        if isinstance(node, ast.BoolOp):
            join = operator.and_ if isinstance(node.op, ast.And) else operator.or_
            return reduce(join, [self.condition(v) for v in node.values])
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
            return ~self.condition(node.operand)
        if isinstance(node, ast.Compare):
            return self.comparison(node.left, node.ops[0], node.comparators[0])
        return truth(self.cell(node))

    def comparison(self, left: ast.expr, op: ast.cmpop, right: ast.expr) -> Column:
        if isinstance(op, (ast.Is, ast.IsNot)):
            subject = self.cell(left)
            empty = F.lit(True) if subject.family == "null" else subject.empty()
            return empty if isinstance(op, ast.Is) else ~empty
        if isinstance(op, (ast.In, ast.NotIn)):
            found = self.membership(self.cell(left), right)
            return found if isinstance(op, ast.In) else ~found
        return compare(OPERATORS[type(op)], self.cell(left), self.cell(right))

    def membership(self, subject: Cell, right: ast.expr) -> Column:
        ends = range_ends(right)
        if ends:
            low, high = map(self.cell, ends)
            return compare(operator.ge, subject, low) & compare(operator.le, subject, high)
        nodes = list_items(right)
        literals = [self.literal(n) for n in nodes]
        if subject.family == "text" and all(isinstance(v, str) for v in literals):
            listed = subject.col.isin(*literals)
            near = case_key(subject.col).isin(*[case_key(F.lit(v)) for v in literals])
            return F.when(listed | ~near, listed)
        if subject.family in ("integer", "number") and all(
            isinstance(v, (int, float)) for v in literals
        ):
            return subject.col.isin(*literals)
        return reduce(
            operator.or_, [compare(operator.eq, subject, self.cell(n)) for n in nodes]
        )

    def literal(self, node: ast.expr):
        """Value of a literal list item, or None for anything else."""
        if isinstance(node, ast.Name) and self.leaves[node.id].kind != "name":
            return self.leaves[node.id].value
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -self.leaves[node.operand.id].value
        return None


def compile_check(
    name: str, expr: str, cells: dict[str, Cell], dialect: str = "postgres"
) -> CompiledCheck:
    """One boolean Column for a CHECK over the given cells (keys in lower case)."""
    tree, leaves = parse_check(expr, dialect)
    work = _Translation(leaves, cells)
    if isinstance(tree, (ast.Name, ast.Constant)) or (
        isinstance(tree, ast.UnaryOp) and isinstance(tree.op, ast.USub)
    ):
        # A bare value is a verdict only if it is a boolean; others always pass.
        cell = work.cell(tree)
        if cell.raw:
            holds = F.when(cell.kind() == "BOOLEAN", F.try_variant_get(cell.col, "$", "boolean"))
        else:
            holds = cell.col if cell.family == "boolean" else unknown()
    else:
        holds = work.condition(tree)
    named = {leaf.value for leaf in leaves.values() if leaf.kind == "name"}
    return CompiledCheck(
        name, expr, tuple(c.name for key, c in cells.items() if key in named), holds
    )


def compile_checks(
    checks, cells: dict[str, Cell], dialect: str = "postgres"
) -> tuple[list[CompiledCheck], list[tuple[str, str, str]]]:
    """Compile what can be evaluated; the rest is (name, expr, reason) to report."""
    compiled, skipped = [], []
    for check in checks:
        expr = normalize_check(check.expr)
        if not expr:
            continue
        try:
            compiled.append(compile_check(check.name, expr, cells, dialect))
        except UnsupportedCheck as reason:
            skipped.append((check.name, expr, str(reason)))
    return compiled, skipped


def referenced_columns(expr: str, columns: list[str], dialect: str = "postgres") -> list[str]:
    """Columns a CHECK mentions, in table order; none if it cannot be read."""
    try:
        found = _lex(expr, dialect)
    except UnsupportedCheck:
        return []
    names = {m.group().lower() for m in found if m.lastgroup == "word"}
    for m in found:
        if m.lastgroup == "quoted":
            mark = m.group()[0]
            names.add(m.group()[1:-1].replace(mark * 2, mark).lower())
    return [c for c in columns if c.lower() in names]


# ---- catalogs of CHECKs ---------------------------------------------------


def normalized_check(definition: Column) -> Column:
    """``normalize_check`` over a catalog column."""
    bare = strip_space(F.regexp_replace(strip_space(definition), "(?is)^check", ""))
    return strip_space(F.regexp_replace(bare, "(?is)not valid$", ""))


def _inside(quoted: Column) -> Column:
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def check_names(expr: Column, dialect: str = "postgres") -> Column:
    """Lower-case names a CHECK mentions; empty if it holds unreadable characters."""
    text = STRING_TEXT[dialect]
    blanked = F.regexp_replace(expr, rf"(?s)(?:_[A-Za-z0-9_$]*(?='))?{text}", " ")
    any_lexeme = f"{QUOTED_NAME}|{NUMBER}|{WORD}|{SYMBOL}|{BLANK}"
    lexemes = F.regexp_extract_all(blanked, F.lit(f"({any_lexeme})"), F.lit(1))
    names = F.filter(lexemes, lambda x: x.rlike('^[A-Za-z_`"]'))
    unquoted = F.transform(
        names,
        lambda x: F.lower(
            F.when(
                x.startswith("`"),
                F.replace(_inside(x), F.lit("``"), F.lit("`")),
            )
            .when(
                x.startswith('"'),
                F.replace(_inside(x), F.lit('""'), F.lit('"')),
            )
            .otherwise(x)
        ),
    )
    readable = F.regexp_replace(blanked, any_lexeme, "") == ""
    return F.when(readable, F.array_distinct(unquoted)).otherwise(
        F.array().cast(T.ArrayType(T.StringType()))
    )


def skipped_checks(checks: DataFrame, dialect: str = "postgres") -> DataFrame:
    """CHECKs of a catalog that cannot be evaluated here, with the reason.

    ``checks`` has ``table_name, name, expr, cols``. Every distinct text is
    read once, whatever number of tables repeats it: the texts are
    de-duplicated before the Arrow batch function and the verdicts joined back.
    """
    @F.pandas_udf("string")
    def reason(exprs: pd.Series) -> pd.Series:
        def read(expr):
            try:
                parse_check(expr, dialect)
            except UnsupportedCheck as why:
                return str(why)
            return None

        return exprs.map(read)

    from rowsluice.operators.keys import join_by_key

    texts = checks.groupBy("expr").agg(F.count(F.lit(1)).alias("uses"))
    refused = texts.withColumn("reason", reason("expr")).filter(F.col("reason").isNotNull())
    return join_by_key(checks, refused, ["expr"], weight="uses", spread=["table_name", "name"]).drop(
        "uses"
    )
