"""Read-only check of SQL texts and filter fragments.

Spark's own parser reads the text; the check walks the resulting tree.  It allows query
nodes over attached views only.  This prevents accidents; it is not a security boundary.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

MAX_BYTES = 20_000
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
FIELD_LIST = re.compile(r"[A-Za-z0-9_.,* ]+")

# Functions that call arbitrary class methods (fixed values).
REFUSED_FUNCTIONS = {"reflect", "java_method", "try_reflect"}
# Table functions that only rearrange their arguments (fixed values).
TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple"}
# Node classes a query may be parsed into (fixed values); any other class is refused.
QUERY_NODES = frozenset("""
Aggregate Cube Distinct Except Filter Generate GlobalLimit GroupingSets Intersect Join LateralJoin LimitAll LocalLimit
LocalRelation Offset OneRowRelation Pivot Project RepartitionByExpression Rollup Sample Sort SubqueryAlias Union Unpivot
UnresolvedGenerator UnresolvedHaving UnresolvedHint UnresolvedRelation UnresolvedSubqueryColumnAliases
UnresolvedTableValuedFunction UnresolvedWith WithWindowDefinition
Exists InSubquery LateralSubquery ListQuery ScalarSubquery
""".split())
FIELD_NODES = frozenset("""
Add AggregateExpression Alias And AnyValue AttributeReference BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast
Coalesce Collate CreateNamedStruct CurrentRow Divide EqualNullSafe EqualTo First GreaterThan GreaterThanOrEqual ILike In
IntegralDivide IsNotNull IsNull IsUnknown LambdaFunction Last LessThan LessThanOrEqual Like LikeAll LikeAny Literal Lower
MultiAlias Multiply NamePlaceholder Not NotLikeAll NotLikeAny Or Overlay RLike Remainder SemiStructuredExtract ShiftLeft
ShiftRight ShiftRightUnsigned SortOrder SpecifiedWindowFrame StringLocate StringTrim StringTrimLeft StringTrimRight
Substring Subtract TimestampAdd TimestampDiff UnaryMinus UnaryPositive UnboundedFollowing UnboundedPreceding
UnresolvedAlias UnresolvedAttribute UnresolvedCollation UnresolvedExtractValue UnresolvedFunction
UnresolvedNamedLambdaVariable UnresolvedOrdinal UnresolvedStar UnresolvedStarExceptOrReplace UnresolvedWindowExpression
UnspecifiedFrame WindowExpression WindowSpecDefinition
""".split())


class Refused(ValueError):
    """The text is not a single read-only query over attached layers."""


def is_name(text: str) -> bool:
    return bool(NAME.fullmatch(text))


def is_field_list(text: str) -> bool:
    return bool(FIELD_LIST.fullmatch(text))


def _parser(spark: SparkSession):
    return spark._jsparkSession.sessionState().sqlParser()


def _nodes(tree) -> list[dict]:
    """All nodes of a plan or expression, nested plans included."""
    out: list[dict] = []
    stack = [tree]
    while stack:
        item = stack.pop()
        if isinstance(item, dict):
            if "class" in item:
                out.append(item)
            stack.extend(item.values())
        elif isinstance(item, list):
            stack.extend(item)
    return out


def _words(value) -> list[str]:
    """Name parts, which the tree prints either as a list or as ``[a, b]``."""
    if isinstance(value, list):
        return [str(v) for v in value]
    return [v.strip() for v in str(value).strip("[]").split(",")]


def check_query(spark: SparkSession, sql: str, relations: set[str]) -> None:
    """Raise ``Refused`` unless ``sql`` is one query over ``relations``."""
    if len(sql.encode()) > MAX_BYTES:
        raise Refused(f"query longer than {MAX_BYTES} bytes")
    bare = re.sub(r"(?s)^(\s|--[^\n]*\n|/\*.*?\*/|\()+", "", sql)
    first = re.match(r"[A-Za-z]*", bare).group().lower()
    if first not in ("select", "with"):
        raise Refused("only SELECT or WITH queries are allowed")
    try:
        plan = _parser(spark).parsePlan(sql)
    except Exception as e:  # the JVM's ParseException
        raise Refused(f"not a single query: {str(e).splitlines()[0]}") from None
    _check(json.loads(plan.toJSON()), {r.lower() for r in relations}, QUERY_NODES | FIELD_NODES)


def _kind(node: dict) -> str:
    """Simple class name; objects and anonymous classes end in ``$`` and more."""
    return node["class"].rsplit(".", 1)[-1].split("$", 1)[0]


def _check(tree, relations: set[str], allowed: frozenset[str]) -> None:
    nodes = _nodes(tree)
    ctes = set()
    for n in nodes:
        if n["class"].endswith(".UnresolvedWith"):
            ctes |= _cte_names(n)
    for n in nodes:
        kind = _kind(n)
        if kind not in allowed:
            raise Refused(f"{kind} is not part of a read-only query")
        if kind == "UnresolvedFunction":
            name = _words(n.get("nameParts", []))[-1].lower()
            if name in REFUSED_FUNCTIONS:
                raise Refused(f"function {name} is not allowed")
        if kind in ("UnresolvedTableValuedFunction", "UnresolvedGenerator"):
            said = n.get("name", n.get("nameParts", []))
            name = str(said["funcName"]).lower() if isinstance(said, dict) else _words(said)[-1].lower()
            if name not in TABLE_FUNCTIONS:
                raise Refused(f"table function {name} is not allowed")
        if kind == "UnresolvedRelation":
            parts = _words(n.get("multipartIdentifier", []))
            if len(parts) != 1 or parts[0].lower() not in relations | ctes:
                raise Refused(f"unknown relation {'.'.join(parts)}; attach it first")


def _cte_names(node: dict) -> set[str]:
    """Names bound by a WITH clause."""
    return {r["_1"].lower() for r in node.get("cteRelations") or [] if "_1" in r}


def check_fragment(spark: SparkSession, text: str) -> None:
    """Raise ``Refused`` unless ``text`` is one expression over fields."""
    if len(text.encode()) > MAX_BYTES:
        raise Refused(f"filter longer than {MAX_BYTES} bytes")
    try:
        tree = json.loads(_parser(spark).parseExpression(text).toJSON())
    except Exception as e:  # the JVM's ParseException
        raise Refused(f"not a single filter expression: {str(e).splitlines()[0]}") from None
    _check(tree, set(), FIELD_NODES)


def check_fields(text: str, what: str) -> None:
    if not is_field_list(text):
        raise Refused(f"{what} must be a plain field list")
