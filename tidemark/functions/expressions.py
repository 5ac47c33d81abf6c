"""String predicates and string expressions, handed to Spark's own expression parser.

Spark reads the text; only what its SQL writes otherwise is rewritten first: divisors
(zero gives NULL), ``//``, ``**`` (from the right), ``~``, ``&``, ``|`` and ``in [..]``. Operands are taken as whole tokens.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

_ASSIGNMENT = re.compile(r"^\s*([A-Za-z_]\w*)\s*=(?!=)\s*(.+)$", re.DOTALL)
_TOKEN = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""  # texts
    r"""|(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\w*"""  # numbers
    r"""|(?:`[^`]*`|[^\W\d]\w*)(?:\.(?:`[^`]*`|\w+))*"""  # names
    r"""|\*\*|//|\|\||&&|\s+|.""",
    re.DOTALL,
)
_OPENING, _CLOSING = {"(": ")", "[": "]"}, {")": "(", "]": "["}


def _tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def _group_end(tokens: list[str], at: int) -> int:
    """Index just past the bracket or ``end`` that closes what opens at ``at``."""
    depth = 0
    for i in range(at, len(tokens)):
        word = tokens[i].lower()
        depth += (word in _OPENING or word == "case") - (word in _CLOSING or word == "end")
        if depth == 0:
            return i + 1
    raise ValueError(f"unbalanced brackets in {''.join(tokens)!r}")


def _operand_end(tokens: list[str], at: int) -> int:
    """Index just past the operand that starts at ``at``: a value, call, subscript, bracket or case."""
    while at < len(tokens) and (tokens[at].isspace() or tokens[at] in "+-~"):
        at += 1
    if at == len(tokens):
        return at
    at = _group_end(tokens, at) if tokens[at] in _OPENING or tokens[at].lower() == "case" else at + 1
    while at < len(tokens) and tokens[at] in _OPENING:  # arguments, subscripts
        at = _group_end(tokens, at)
    return at


def _power_end(tokens: list[str], at: int) -> int:
    """As :func:`_operand_end`, with the powers that the operand is raised to: these group from the right."""
    at = _operand_end(tokens, at)
    while True:
        sign = at
        while sign < len(tokens) and tokens[sign].isspace():
            sign += 1
        if sign == len(tokens) or tokens[sign] != "**":
            return at
        at = _operand_end(tokens, sign + 1)


def _operand_start(tokens: list[str]) -> int:
    """Index of the start of the operand that ends the list."""
    at = len(tokens)
    while at and tokens[at - 1].isspace():
        at -= 1
    while at:
        at -= 1
        word = tokens[at].lower()
        if word in _CLOSING or word == "end":
            depth = 1
            while at and depth:
                at -= 1
                word = tokens[at].lower()
                depth += (word in _CLOSING or word == "end") - (word in _OPENING or word == "case")
            if at and tokens[at] in _OPENING and re.match(r"[`\w]", tokens[at - 1][-1:]):
                continue  # a call or subscript: its name belongs to it
        return at
    return at


def _operator_before(tokens: list[str], at: int) -> int | None:
    """Index of the operator of the same rank as division right before ``at``, if there is one."""
    while at and tokens[at - 1].isspace():
        at -= 1
    return at - 1 if at and tokens[at - 1] in ("*", "/", "%") else None


def _rewrite(tokens: list[str]) -> list[str]:
    out: list[str] = []
    at = 0
    while at < len(tokens):
        word = tokens[at]
        if word in ("/", "%", "//", "**"):
            end = _power_end(tokens, at + 1)
            right = "".join(_rewrite(tokens[at + 1:end])).strip()
            if word in ("/", "%"):
                out += [word, " ", f"nullif({right}, 0)"]
            else:
                start = _operand_start(out)
                while word == "//" and (before := _operator_before(out, start)) is not None:
                    start = _operand_start(out[:before])
                left = "".join(out[start:]).strip()
                made = f"power({left}, {right})" if word == "**" else f"floor({left} / nullif({right}, 0))"
                out[start:] = [made]
            at = end
        elif word == "[" and "".join(out).rstrip().lower().endswith((" in", ")in")):
            end = _group_end(tokens, at)
            out += ["(", *_rewrite(tokens[at + 1:end - 1]), ")"]
            at = end
        elif word == "~":
            end = _operand_end(tokens, at + 1)
            out.append(f"(NOT {''.join(_rewrite(tokens[at + 1:end])).strip()})")
            at = end
        elif word in ("&", "&&", "|"):
            out.append(" OR " if word == "|" else " AND ")
            at += 1
        else:
            out.append(word)
            at += 1
    return out


def spark_text(text: str) -> str:
    """The text as Spark SQL; under ANSI rules x / 0 and x % 0 would fail the job, here they give NULL."""
    return "".join(_rewrite(_tokens(text)))


def expression(text: str) -> Column:
    return F.expr(spark_text(text))


def query(df: DataFrame, text: str) -> DataFrame:
    """Rows where a string predicate holds, e.g. ``(A > 10) & C in ["x", "y"]``.

    Comparisons with NULL are false; NaN counts as larger than all numbers, as everywhere in Spark.
    """
    return df.filter(expression(text))


def evaluate(df: DataFrame, text: str) -> DataFrame:
    """Add a column from ``name = expression``."""
    found = _ASSIGNMENT.match(text)
    if not found:
        raise ValueError("expected 'name = expression'")
    return df.withColumn(found.group(1), expression(found.group(2)))
