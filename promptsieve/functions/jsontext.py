"""JSON values held as text, in Spark SQL snippets and column functions.

Records keep the JSON text they came in, in compact form, because its key order
is the order prompts are reported in.  Where the type of a value matters (the
string "0" against the number 0), the text is tagged, so that a value read as text
shows its type; roles, which are short, are read as VARIANT.  The snippets are SQL
strings because most are used inside lambdas.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptsieve.functions.dialect import literal

# The reader's own limit, 20 million characters, is below what a prompt may be.
_LONGEST = str((1 << 31) - 1)
_STRICT = {"allowSingleQuotes": "false", "maxStringLen": _LONGEST}


def last_key_wins(spark: SparkSession) -> None:
    """Of repeated keys in an object the last value counts, in the first one's
    place, and no reader rejects them.  Every plan that takes JSON apart asks
    for this; it stays set in the session, as plans are run later."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def read_json(text: str, schema: str) -> str:
    """SQL: `from_json` without a limit on the length of strings."""
    return f"from_json({text}, '{schema}', map('maxStringLen', '{_LONGEST}'))"


def members(text: str, leaf: str) -> str:
    """SQL: the values of an object in text order, one per key."""
    return f"map_values(map_from_entries(map_entries({read_json(text, f'map<string,{leaf}>')})))"


def strict_parse(text: Column) -> Column:
    """Compact text of the one JSON value that makes up `text`, or null.

    The value is read as the first element of an array whose second element is
    a digest of the text.  Trailing junk, a second value or an early closing
    bracket all leave something else in the second place.
    """
    seal = F.md5(text)
    boxed = F.from_json(
        F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]')), "array<string>", _STRICT
    )
    whole = (F.size(boxed) == 2) & (F.get(boxed, F.lit(1)) == seal)
    # A container comes back as compact text, a string without its quotes.
    value = F.when(text.rlike(r"^[\[{]"), F.get(boxed, F.lit(0))).otherwise(text)
    return F.when(whole, value)


def truthy(variant: str) -> str:
    """SQL: true for a present value that is not null, empty, zero or false."""
    return f"""to_json({variant}) NOT IN ('null', '""', '0', 'false', '[]', '{{}}')"""


def present(variant: str) -> str:
    """SQL: the variant, with JSON null turned into SQL null."""
    return f"if(is_variant_null({variant}), null, {variant})"


def _aside(text: str) -> str:
    """SQL: JSON text with escaped backslashes and quotes put aside as control
    characters, which JSON text has none of; every quote that is left begins or
    ends a string."""
    return rf"""replace(replace({text}, '\\\\', '\u0001'), '\\"', '\u0002')"""


def _back(text: str) -> str:
    return rf"""replace(replace({text}, '\u0001', '\\\\'), '\u0002', '\\"')"""


# With strings marked, from the last match on: everything up to the next null
# outside a string, where no other word has an n.
_TO_NULL = r'\G((?:"[^"]*+"|[^"n]++)*+)null'


def tagged(text: str) -> str:
    """SQL: JSON text whose strings, keys included, have an s in front, and with
    the string n for null.

    Read as text, a value of it shows by its first character what it is: s for a
    string, n for null, a bracket, or else a number or boolean.  Missing fields
    alone read as SQL null.  No type has a size limit of its own that way.
    """
    strings = f"""regexp_replace({_aside(text)}, {literal('"([^"]*+)"')}, {literal('"s$1"')})"""
    nulls = f"""regexp_replace({strings}, {literal(_TO_NULL)}, {literal('$1"n"')})"""
    return _back(f"if(contains({text}, 'null'), {nulls}, {strings})")


def untagged(text: str) -> str:
    """SQL: tagged text as the JSON it was."""
    nulls = f"""replace({_aside(text)}, '"n"', 'null')"""
    return _back(f"""regexp_replace({nulls}, {literal('"s([^"]*+)"')}, {literal('"$1"')})""")


def tagged_struct(*keys: str, **nested: str) -> str:
    """The type to read an object of tagged text as; its fields are `tag(key)`."""
    fields = [f"{tag(k)}: string" for k in dict.fromkeys(keys)] + [f"{tag(k)}: {v}" for k, v in nested.items()]
    return f"struct<{', '.join(fields)}>"


def tag(key: str) -> str:
    return f"s{key}"


def given(value: str) -> str:
    """SQL: a tagged value, with JSON null as SQL null."""
    return f"nullif({value}, 'n')"


def is_container(value: str) -> str:
    return f"(startswith({value}, '{{') OR startswith({value}, '['))"


def plain(value: str) -> str:
    """SQL: a tagged value as text; null is SQL null."""
    return f"""CASE WHEN startswith({value}, 's') THEN substring({value}, 2) WHEN {is_container(value)} THEN {untagged(value)}
        WHEN {value} = 'n' THEN null ELSE {value} END"""


def is_truthy(value: str) -> str:
    """SQL: true for a present tagged value that is not null, empty, zero or false."""
    return f"""({value} NOT IN ('n', 's', 'false', '[]', '{{}}') AND NOT {value} RLIKE '^-?0+([.]0*)?([eE].*)?$')"""


def tagged_elements(tagged_text: str) -> str:
    """SQL: the children of a tagged container in text order."""
    return f"if(startswith({tagged_text}, '{{'), {members(tagged_text, 'string')}, {read_json(tagged_text, 'array<string>')})"


def elements(array_text: str) -> Column:
    """Compact JSON text of each element of a JSON array."""
    return F.expr(f"""transform({tagged_elements(tagged(array_text))}, e -> CASE
        WHEN e = 'n' THEN 'null'
        WHEN startswith(e, 's') THEN {json_string('substring(e, 2)')}
        WHEN {is_container('e')} THEN {untagged('e')}
        ELSE e END)""")


def sorted_json(value: Column, kind: T.DataType) -> Column:
    """A value of any type as JSON text: keys sorted at every level, a space after
    each comma and colon, null as null.  Numbers and booleans are spelt as Spark
    spells them; what JSON has no type for is a string."""
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: sorted_json(x, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(kind, T.StructType):
        members = [
            F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ": "), sorted_json(value.getField(f.name), f.dataType))
            for f in sorted(kind.fields, key=lambda f: f.name)
        ]
        text = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}")))
    elif isinstance(kind, T.MapType):
        by_key = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        members = F.transform(
            by_key, lambda e: F.concat(_quoted(e["key"]), F.lit(": "), sorted_json(e["value"], kind.valueType))
        )
        text = F.concat(F.lit("{"), F.array_join(members, ", "), F.lit("}"))
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        text = value.cast("string")
    else:
        text = F.when(value.isNotNull(), _quoted(value))
    return F.coalesce(text, F.lit("null"))


def _quoted(value: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(value.cast("string"))), r"^\[|\]$", "")


def json_string(text: str) -> str:
    """SQL: a text as a JSON string."""
    return f"substring(to_json(array({text})), 2, length(to_json(array({text}))) - 2)"


# In compact JSON, from the last match on: everything up to the next comma or
# colon outside a string.
_TO_SEPARATOR = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:])*+)([,:])'


def spaced_json(raw: str) -> str:
    """SQL: JSON text with sorted keys and a space after each comma and colon."""
    return f"regexp_replace(to_json({read_json(raw, 'variant')}), {literal(_TO_SEPARATOR)}, '$1$2 ')"
