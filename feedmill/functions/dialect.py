"""Rule and mapping text as written by analysts, turned into Spark SQL text.

Only the handful of spellings found in rule and mapping tables is translated;
everything else is passed to Spark as it stands.
"""

from __future__ import annotations

import re

from feedmill.functions.dates import spark_pattern
from feedmill.functions.variant import json_path

_OPERATOR_START = re.compile(
    r"^\s*(?:IS\b|(?:NOT\s+)?(?:IN|RLIKE|LIKE|ILIKE|REGEXP|BETWEEN)\b|=|<|>|!=)", re.I
)


def repair_commas(text: str) -> str:
    """Put back the argument commas a CSV export dropped."""
    text = re.sub(r"(TO_DATE\(\s*\w+)\s+(')", r"\1, \2", text, flags=re.I)
    text = re.sub(r"((?:NUMBER|DECIMAL|NUMERIC)\(\s*\d+)\s+(\d+\s*\))", r"\1, \2", text, flags=re.I)
    text = re.sub(r"((?:DATEDIFF|DATEADD)\(\s*'\w+')\s+(\S+)\s+", r"\1, \2, ", text, flags=re.I)
    return re.sub(r"(\bIN\s*\()([^()]*)(\))", _repair_list, text, flags=re.I)


def _repair_list(match: re.Match) -> str:
    return match[1] + re.sub(r"'\s+'", "', '", match[2]) + match[3]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def type_name(warehouse_type: str) -> str:
    """Spark type for a declared column type."""
    text = re.sub(r"\s+", " ", warehouse_type.strip().upper().replace(" AUTOINCREMENT", ""))
    base, _, args = text.partition("(")
    base, args = base.strip(), args.rstrip(") ").replace(" ", ",").replace(",,", ",")
    if base in ("NUMBER", "DECIMAL", "NUMERIC"):
        return f"decimal({args or '38,0'})" if "," in args or not args else f"decimal({args},0)"
    if base in ("INTEGER", "INT", "BIGINT"):
        return "decimal(38,0)"
    if base in ("GEOGRAPHY", "GEOMETRY"):
        raise ValueError(f"type {base} has no Spark equivalent here")
    # Declared type names and their Spark types.
    plain = {
        "VARCHAR": "string", "STRING": "string", "TEXT": "string", "CHAR": "string",
        "FLOAT": "double", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
        "TIMESTAMP_NTZ": "timestamp_ntz", "TIMESTAMP": "timestamp_ntz",
        "TIMESTAMP_LTZ": "timestamp", "TIMESTAMP_TZ": "timestamp",
        "TIME": "string", "VARIANT": "variant", "OBJECT": "variant",
        "ARRAY": "array<variant>", "BINARY": "binary",
    }
    if base not in plain:
        raise ValueError(f"unknown column type: {warehouse_type}")
    return plain[base]


def _path(match: re.Match) -> str:
    field = match["quoted"] or match["plain"]
    as_type = type_name(match["type"]) if match["type"] else "string"
    return f"try_variant_get(RAW_DATA, {_double_quoted(json_path(field))}, '{as_type}')"


def _double_quoted(text: str) -> str:
    return '"' + text.replace('"', '\\"') + '"'


_RAW_PATH = re.compile(
    r"RAW_DATA:(?:\"(?P<quoted>[^\"]+)\"|(?P<plain>\w+))"
    r"(?:::(?P<type>\w+(?:\(\s*\d+\s*(?:,\s*\d+\s*)?\))?))?",
    re.I,
)


def to_spark(text: str) -> str:
    """Translate one expression."""
    out = repair_commas(text.strip().rstrip(";"))
    out = _RAW_PATH.sub(_path, out)
    out = re.sub(
        r"\bRLIKE\s+'((?:[^']|'')*)'",
        lambda m: f"RLIKE {_literal('^(?:' + m[1] + ')$')}",
        out, flags=re.I,
    )
    out = re.sub(
        r"\b(?:TRY_)?TO_(DATE|TIMESTAMP)\(\s*(.+?)\s*,\s*'([^']+)'\s*\)",
        lambda m: f"try_to_{m[1].lower()}({m[2]}, '{spark_pattern(m[3])}')",
        out, flags=re.I,
    )
    out = re.sub(r"\bTRY_TO_DATE\(\s*(\w+)\s*\)", r"TRY_CAST(\1 AS DATE)", out, flags=re.I)
    out = re.sub(r"\bTO_VARCHAR\(\s*(.+?)\s*,\s*'([^']+)'\s*\)",
                 lambda m: f"date_format({m[1]}, '{spark_pattern(m[2])}')", out, flags=re.I)
    out = re.sub(r"(?<!TRY_)\bCAST\(", "TRY_CAST(", out, flags=re.I)
    out = re.sub(r"\bNUMBER(\(\s*\d+\s*,\s*\d+\s*\))", r"DECIMAL\1", out, flags=re.I)
    out = re.sub(r"\bAS\s+NUMBER\b", "AS DECIMAL(38,0)", out, flags=re.I)
    out = re.sub(r"\bAS\s+VARCHAR(\(\s*\d+\s*\))?", "AS STRING", out, flags=re.I)
    out = re.sub(r"\bDATEDIFF\(\s*'?day'?\s*,\s*([^,]+?)\s*,\s*([^,()]+(?:\(\))?)\s*\)",
                 r"datediff(\2, \1)", out, flags=re.I)
    out = re.sub(r"\bDATEDIFF\(\s*'?year'?\s*,\s*([^,]+?)\s*,\s*([^,()]+(?:\(\))?)\s*\)",
                 r"(year(\2) - year(\1))", out, flags=re.I)
    out = re.sub(r"\bDATEADD\(\s*'?day'?\s*,\s*(-?\d+)\s*,\s*([^,()]+(?:\(\))?)\s*\)",
                 r"date_add(\2, \1)", out, flags=re.I)
    return re.sub(r"\bCURRENT_TIMESTAMP\(\)", "localtimestamp()", out, flags=re.I)


def predicate(column: str | None, logic: str) -> str:
    """Full condition of a rule: ``column logic`` unless the text already is one."""
    text = to_spark(logic)
    if column and _OPERATOR_START.match(text):
        return f"{column} {text}"
    return text


def source_expression(fields: str | list[str], logic: str | None) -> str:
    """Mapping expression over ``RAW_DATA``; ``source_value`` stands for the field.

    Of several spellings of the field the first present one is taken.
    """
    names = [fields] if isinstance(fields, str) else fields
    reads = [f"try_variant_get(RAW_DATA, {_double_quoted(json_path(name))}, 'string')" for name in names]
    value = reads[0] if len(reads) == 1 else f"coalesce({', '.join(reads)})"
    if not logic or not logic.strip():
        return value
    return re.sub(r"\bsource_value\b", lambda _: value, to_spark(logic), flags=re.I)


def standard_expression(column: str, logic: str) -> str:
    """Standardisation text: a bare function name or a full expression."""
    text = to_spark(logic)
    if re.fullmatch(r"\w+", text):
        name = {"PROPER": "initcap", "INITCAP": "initcap"}.get(text.upper(), text)
        return f"{name}({column})"
    return re.sub(r"\bsource_value\b", column, text, flags=re.I)
