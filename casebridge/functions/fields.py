"""JSON document columns: read ``{"<field>": {"value": ...}}`` values, set one, merge two documents.

Edits work on the text. A pattern finds the members of a document, and a fold over its tokens those of one nested deeper than
the pattern reaches; members that an edit does not name come back as they were written, numbers with all their digits included.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the parser makes of a number that is no short integer.
_DECIMAL = r"^-?[0-9]+(\.[0-9]+([eE]-?[0-9]+)?|[0-9]{17,})$"
# Strings, structure, and all else; possessive, so that long strings need no stack.
_TOKEN = r'(?s)"(?:[^"\\]++|\\.)*+"|[{}\[\],:]|[^"{}\[\],:]++'
#: Levels below a member's value that one pattern covers; as deep as documents of events go, with room.
LEVELS = 4
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_BLANK = r"[ \t\r\n]*+"


def _nested(levels: int) -> str:
    """Text between brackets, which holds brackets that many levels deep."""
    inner = rf"|[{{\[]{_nested(levels - 1)}[}}\]]" if levels else ""
    return rf'(?:[^"{{}}\[\]]++|{_STRING}{inner})*+'


# Possessive throughout, so that neither long nor wide documents need a stack.
_VALUE = rf'(?:[^"{{}}\[\],]++|{_STRING}|[{{\[]{_nested(LEVELS)}[}}\]])++'
_PAIR = rf"{_BLANK}{_STRING}{_BLANK}:{_VALUE}"
_FLAT = rf"(?s)\A\s*+\{{(?:{_PAIR}(?:,{_PAIR})*+|{_BLANK})\}}\s*+\z"
# A member starts where the object or the member before it ends.
_MEMBER = rf"(?s)(?:\A\s*+\{{|\G,)({_BLANK}{_STRING}{_BLANK}):({_VALUE})"
_PLAIN_NAME = r'\A[ \t\r\n]*+"([^"\\\x00-\x1F]++)"[ \t\r\n]*+\z'
_FOUND = "array<struct<start:int,colon:int,end:int>>"
_STATE = f"struct<at:int,depth:int,start:int,colon:int,found:{_FOUND}>"


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def members(document: Column) -> Column:
    """Members of the text of an object, in order: ``key``, the text around the colon (``name``, ``value``).

    Blanks between tokens belong to the text before or after the colon. Text that is no object has no members; the
    text must be valid JSON. Members nested up to ``LEVELS`` deep are matched whole, deeper ones by a fold over tokens.
    """

    def matched(text: Column) -> Column:
        def part(group: int) -> Column:
            return F.regexp_extract_all(text, F.lit(_MEMBER), F.lit(group))

        return F.transform(F.arrays_zip(part(1).alias("name"), part(2).alias("value")), keyed)

    def keyed(m: Column) -> Column:
        # Empty where the name has escapes, which take a parser.
        plain = F.nullif(F.regexp_extract(m["name"], _PLAIN_NAME, 1), F.lit(""))
        key = F.coalesce(plain, F.get_json_object(F.concat(F.lit("["), m["name"], F.lit("]")), "$[0]"))
        return F.struct(key.alias("key"), m["name"].alias("name"), m["value"].alias("value"))

    return F.when(document.rlike(_FLAT), matched(document)).otherwise(F.transform(_folded(document), keyed))


def _folded(document: Column) -> Column:
    """``name`` and ``value`` of the members of any object, however deep."""
    tokens = F.regexp_extract_all(document, F.lit(f"({_TOKEN})"), F.lit(1))

    def state(at: Column, depth: Column, start: Column, colon: Column, found: Column) -> Column:
        named = [c.alias(n) for c, n in zip((at, depth, start, colon, found), ("at", "depth", "start", "colon", "found"), strict=True)]
        return F.struct(*named).cast(_STATE)

    def step(s: Column, token: Column) -> Column:
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        at = s["at"] + 1  # tokens read, this one included: the place of the next
        begins = (s["depth"] == 0) & opens
        ends = (s["depth"] == 1) & (closes | (token == ","))
        member = F.struct(s["start"].alias("start"), s["colon"].alias("colon"), s["at"].alias("end"))
        return state(
            at,
            s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0),
            F.when(begins | ends, at).otherwise(s["start"]),
            F.when(begins | ends, -1).when((s["depth"] == 1) & (token == ":") & (s["colon"] < 0), s["at"]).otherwise(s["colon"]),
            F.when(ends & (s["colon"] >= 0), F.concat(s["found"], F.array(member))).otherwise(s["found"]),
        )

    def texts(tokens: Column) -> Column:
        def part(first: Column, last: Column) -> Column:
            return F.array_join(F.slice(tokens, first + 1, last - first), "")

        zero = state(F.lit(0), F.lit(0), F.lit(0), F.lit(-1), F.array())
        found = F.aggregate(tokens, zero, step, lambda s: s["found"])
        return F.transform(found, lambda m: F.struct(part(m["start"], m["colon"]).alias("name"), part(m["colon"] + 1, m["end"]).alias("value")))

    return _held(tokens, texts)


def _is_object(text: Column) -> Column:
    return text.rlike(r"^\s*\{") & F.try_parse_json(text).isNotNull()


def _written(found: Column) -> Column:
    """The text of an object with these members."""
    pairs = F.transform(found, lambda m: F.concat(m["name"], F.lit(":"), m["value"]))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _member(name: Column, value: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"))


def read_fields(df: DataFrame, document: str, fields: Mapping[str, str]) -> DataFrame:
    """Add one text column per (alias, field), NULL where the field or its value is missing.

    Strings come as parsed. A number comes as it is written in the document: the parser would turn 1.50 into 1.5 and
    cut long decimals, so a value that looks like such a number is read off the text.

    The document is parsed once per row. ``explode`` of the one-element array keeps Catalyst from
    pushing filters on the new columns below the parse, where each would parse the text again.
    """
    names = dict.fromkeys(fields.values())
    schema = T.StructType([T.StructField(f, T.StructType([T.StructField("value", T.StringType())])) for f in names])
    parsed = df.select("*", F.explode(F.array(F.from_json(document, schema))).alias("_doc"))
    numeric = reduce(lambda a, b: a | b, [F.col(f"_doc.`{f}`.value").rlike(_DECIMAL) for f in names])
    # Cut up only where some value looks like a number.
    written = F.when(numeric, _value_texts(F.col(document), list(names)))
    found = parsed.select("*", F.explode(F.array(written)).alias("_texts"))
    return found.select("*", *[_as_written(f).alias(a) for a, f in fields.items()]).drop("_doc", "_texts")


def _last(found: Column, key: str) -> Column:
    """The text of the member's value; of members of one name the last counts."""
    return F.get(F.transform(F.filter(F.reverse(found), lambda m: m["key"] == key), lambda m: m["value"]), F.lit(0))


def _value_texts(document: Column, names: list[str]) -> Column:
    """``key`` and the text of the inner ``value`` of the document's members with these names."""
    named = F.filter(members(document), lambda m: m["key"].isin(names))
    return F.transform(named, lambda m: F.struct(m["key"].alias("key"), F.trim(_last(members(m["value"]), "value")).alias("value")))


def _as_written(field: str) -> Column:
    """The parsed value, or the number's own text where the document holds it as a number."""
    value, text = F.col(f"_doc.`{field}`.value"), _last(F.col("_texts"), field)
    # Nested, not joined by "and": the text is only looked at for values that look like numbers.
    return F.when(value.rlike(_DECIMAL), F.when(text.startswith('"'), value).otherwise(text)).otherwise(value)


def set_value(document: Column, field: str, value: Column) -> Column:
    """Set ``document[field].value``; other content stays. A field that is absent or no object stays as it is."""
    written = F.to_json(F.struct(value.alias("value")), {"ignoreNullFields": "false"})
    token = F.regexp_extract(written, r"(?s)^\{\"value\":(.*)\}$", 1)

    def with_value(found: Column) -> Column:
        changed = F.transform(found, lambda m: _member(m["name"], F.when(m["key"] == "value", token).otherwise(m["value"])))
        added = F.concat(changed, F.array(_member(F.lit('"value"'), token)))
        return _written(F.when(F.exists(found, lambda m: m["key"] == "value"), changed).otherwise(added))

    def edited(m: Column) -> Column:
        return _member(m["name"], F.when((m["key"] == field) & m["value"].rlike(r"^\s*\{"), _held(members(m["value"]), with_value)).otherwise(m["value"]))

    return F.when(_is_object(document), _written(F.transform(members(document), edited))).otherwise(document)


def merge(left: Column, right: Column, only: tuple[str, ...] | None = None) -> Column:
    """Top-level merge where the right side wins whole fields, JSON nulls included. NULL unless both are objects."""
    new = members(right)
    if only is not None:
        new = F.filter(new, lambda m: m["key"].isin(*only))

    def joined(pair: Column) -> Column:
        names = F.transform(pair["new"], lambda m: m["key"])
        kept = F.filter(pair["old"], lambda m: ~F.array_contains(names, m["key"]))
        return _written(F.concat(kept, pair["new"]))

    pair = F.struct(members(left).alias("old"), new.alias("new"))
    return F.when(_is_object(left) & _is_object(right), _held(pair, joined))


def message_text(prefix: str, *parts: str) -> Column:
    """Prefix and space-separated parts; NULL counts as empty text."""
    pieces: list[Column] = [F.lit(prefix)]
    for i, part in enumerate(parts):
        pieces += [F.lit(" ")] * (i > 0) + [F.col(part)]
    return F.concat_ws("", *pieces)
