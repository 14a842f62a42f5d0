"""Context resolution over polymorphic JSON fields.

Tiers, first non-blank wins; only element 0 of a list is looked at:

1. ``entity_pages[0]`` object -> first truthy of wiki_context, text, content
2. ``evidence[0]`` object -> text, value; or ``evidence[0]`` string itself
3. ``search_results[0]`` object -> description, snippet, title; or, when
   ``search_results`` is an object, its values in insertion order, each an
   object or a non-empty list whose element 0 is an object
4. the placeholder

A picked value counts only when it is a JSON string (anything else is
treated as missing). A whitespace-only value wins its ``or`` chain and then
trims to blank, failing the whole tier, as in the reference.

A column is read by its type, which the plan knows: JSON text and VARIANT by
paths, and a real list, struct or map by its fields (``TypedField``). A struct
or map is an object, whose values are walked in field or entry order; nulls in
it are missing keys. Only string fields count. Both forms of one value give the
same context.

JSON text that repeats a key is read as the usual parsers do: the last value
counts. Text that is no JSON at all is a missing field; ``context_fields``
counts both.

Staged projections: each JSON field is parsed once, each path read once,
and each tier trimmed once (a single nested expression would repeat the
parse inside every ``nullif``/``coalesce`` branch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.config import ENTITY_PAGE_KEYS, EVIDENCE_KEYS, NO_CONTEXT_PLACEHOLDER, SEARCH_RESULT_KEYS
from chatmill.functions.text import first_nonempty, py_trim


def as_string(v: Column) -> Column:
    """VARIANT -> its string if it holds a JSON string, else null."""
    return F.when(F.schema_of_variant(v) == F.lit("STRING"), F.try_variant_get(v, "$", "string"))


def string_at(v: Column, path: str) -> Column:
    return as_string(F.try_variant_get(v, path, "variant"))


def _blank_to_null(c: Column) -> Column:
    return F.when(c != F.lit(""), c)


class TypedField:
    """A column of real nested type: what the tiers read from it.

    ``struct_of_arrays`` also reads an object of parallel lists, by element 0 of each.
    """

    def __init__(self, col: Column, kind: T.DataType, struct_of_arrays: bool = False):
        self.col, self.kind, self.struct_of_arrays = col, kind, struct_of_arrays

    @staticmethod
    def _strings(col: Column, kind: T.DataType, keys) -> list[Column]:
        """An object's values under ``keys``, as far as they are strings."""
        if isinstance(kind, T.StructType):
            names = {f.name: f.dataType for f in kind.fields}
            read = [(col[k], names[k]) for k in keys if k in names]
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            read = [(F.try_element_at(col, F.lit(k)), kind.valueType) for k in keys]
        elif isinstance(kind, T.VariantType):
            return [string_at(col, f"$.{k}") for k in keys]
        else:
            return []
        return [as_string(c) if isinstance(t, T.VariantType) else c for c, t in read if isinstance(t, (T.StringType, T.VariantType))]

    def _first(self) -> tuple[Column, T.DataType] | None:
        """Element 0 of a list and its type."""
        if not isinstance(self.kind, T.ArrayType):
            return None
        return F.get(self.col, F.lit(0)), self.kind.elementType

    def list_pick(self, keys) -> Column:
        """C2 over element 0 of a list, if it is an object; "" if there is none."""
        first = self._first()
        strings = self._strings(*first, keys) if first else []
        if self.struct_of_arrays and isinstance(self.kind, T.StructType):
            lists = {f.name for f in self.kind.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)}
            strings = [F.get(self.col[k], F.lit(0)) for k in keys if k in lists]
        return first_nonempty(*strings)

    def list_string(self) -> Column:
        """Element 0 of a list, if it is a string, else null."""
        first = self._first()
        if first and isinstance(first[1], T.StringType):
            return first[0]
        return as_string(first[0]) if first and isinstance(first[1], T.VariantType) else F.lit(None).cast("string")

    def walk(self, keys) -> Column:
        """C2 over every value of an object that is an object, or a list whose
        element 0 is one, in order."""
        def pick(col: Column, kind: T.DataType) -> Column | None:
            if isinstance(kind, T.VariantType):
                return first_nonempty(*[string_at(col, f"{at}.{k}") for at in ("$", "$[0]") for k in keys])
            if isinstance(kind, T.ArrayType):
                return pick(F.get(col, F.lit(0)), kind.elementType) if not isinstance(kind.elementType, T.ArrayType) else None
            strings = self._strings(col, kind, keys)
            return first_nonempty(*strings) if strings else None

        if isinstance(self.kind, T.StructType):
            picks = [c for f in self.kind.fields if (c := pick(self.col[f.name], f.dataType)) is not None]
            return F.array(*picks) if picks else F.array().cast("array<string>")
        if isinstance(self.kind, T.MapType):
            none = F.array().cast("array<string>")
            if pick(F.lit(None), self.kind.valueType) is None:
                return none
            return F.coalesce(F.transform(F.map_values(self.col), lambda v: pick(v, self.kind.valueType)), none)
        return F.array().cast("array<string>")


#: Fallback parse of text that repeats keys: nothing else is let through.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_LIST, _STRING_LIST, _OBJECT_LIST, _OBJECT = r"^\s*\[", r"^\s*\[\s*\"", r"^\s*\[\s*\{", r"^\s*\{"


def _repeated(text: Column, parsed: Column, shape: str) -> Column:
    """Whether JSON text of a shape did not parse, for repeated keys perhaps."""
    return parsed.isNull() & text.rlike(shape)


def _last_values(text: Column, keys) -> list[Column]:
    """Strings under ``keys`` of JSON text that is an object, or a list that
    begins with one, the last of repeated ones."""
    first = F.when(text.rlike(_OBJECT), text).when(text.rlike(_OBJECT_LIST), F.get(F.from_json(text, "array<string>", _STRICT), F.lit(0)))
    fields = F.from_json(first, "struct<" + ",".join(f"`{k}`:variant" for k in keys) + ">", _STRICT)
    return [as_string(fields[k]) for k in keys]


def _walk_repeated(text: Column, keys) -> Column:
    """The picks of an object's values, where keys repeat: every key at its
    first place with its last value, as text. (A string value that is itself
    JSON text reads as what it holds.)"""
    entries = F.map_entries(F.from_json(text, "map<string,string>", _STRICT))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(names, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"])
    return F.transform(last, lambda v: first_nonempty(*_last_values(v, keys)))


def resolve_context(df: DataFrame, placeholder: str = NO_CONTEXT_PLACEHOLDER, name: str = "context",
                    entity_pages: str = "entity_pages", evidence: str = "evidence",
                    search_results: str = "search_results", struct_of_arrays: bool = False) -> DataFrame:
    """Append ``name`` resolved from the three columns, each JSON text, VARIANT
    (whose objects have their keys sorted) or of a real nested type.

    ``struct_of_arrays`` (opt-in deviation) also reads the column-oriented
    shape some loaders produce, an object of parallel lists such as
    ``{"wiki_context": ["..."], ...}``, taking element 0 of each list. As
    written, the reference rejects that shape and falls to the placeholder.
    """
    keep = [c for c in df.columns]
    kinds = {alias: df.select(c).schema[0].dataType for alias, c in (("_ep", entity_pages), ("_ev", evidence), ("_sr", search_results))}
    text = {alias for alias, kind in kinds.items() if isinstance(kind, T.StringType)}
    untyped = {alias for alias, kind in kinds.items() if isinstance(kind, (T.StringType, T.VariantType, T.NullType))}
    cols = {"_ep": F.col(entity_pages), "_ev": F.col(evidence), "_sr": F.col(search_results)}
    typed = {alias: TypedField(cols[alias], kinds[alias], struct_of_arrays) for alias in kinds if alias not in untyped}
    soa = (lambda k: [f"$.{k}[0]"]) if struct_of_arrays else (lambda k: [])
    paths = [(g, src, p) for g, src, p in (
        [("ep", "_ep", p) for k in ENTITY_PAGE_KEYS for p in [f"$[0].{k}"] + soa(k)]
        + [("ev0", "_ev", "$[0]")]
        + [("ev", "_ev", f"$[0].{k}") for k in EVIDENCE_KEYS]
        + [("sr", "_sr", p) for k in SEARCH_RESULT_KEYS for p in [f"$[0].{k}"] + soa(k)]) if src in untyped]
    parsed = [(F.try_parse_json(cols[a].cast("string")) if not isinstance(kinds[a], T.VariantType) else cols[a]).alias(a) for a in sorted(untyped)]
    # object walk: from_json keeps insertion order (VARIANT sorts keys); null for a list
    values = (F.from_json(cols["_sr"], "map<string,variant>") if "_sr" in text else F.try_variant_get(cols["_sr"], "$", "map<string,variant>")
              if isinstance(kinds["_sr"], T.VariantType) else F.lit(None).cast("map<string,variant>"))
    x = df.select(*keep, *parsed, F.map_values(values).alias("_srv"))
    carried = [a for a in ("_ep", "_ev", "_sr") if a in text]       # whether they parsed
    x = x.select(*keep, "_srv", *[F.col(a).isNotNull().alias(f"{a}_ok") for a in carried],
                 *[F.try_variant_get(F.col(src), p, "variant").alias(f"_v{i}") for i, (_, src, p) in enumerate(paths)])
    flags = [f"{a}_ok" for a in carried]
    x = x.select(*keep, "_srv", *flags, *[as_string(F.col(f"_v{i}")).alias(f"_s{i}") for i in range(len(paths))])
    s = {g: [F.col(f"_s{i}") for i, (gg, _, _) in enumerate(paths) if gg == g] for g in ("ep", "ev0", "ev", "sr")}

    def again(alias, shape, read):
        """A fallback on text that did not parse, else null."""
        return F.when(_repeated(cols[alias], F.nullif(F.col(f"{alias}_ok"), F.lit(False)), shape), read) if alias in text else None

    for group, alias, keys in (("ep", "_ep", ENTITY_PAGE_KEYS), ("ev", "_ev", EVIDENCE_KEYS), ("sr", "_sr", SEARCH_RESULT_KEYS)):
        if alias in text:
            s[group] += [again(alias, _LIST, c) for c in _last_values(cols[alias], keys)]
    if "_ev" in text:
        s["ev0"].append(again("_ev", _STRING_LIST, F.get(F.from_json(cols["_ev"], "array<string>", _STRICT), F.lit(0))))
    walk_paths = [f"$.{k}" for k in SEARCH_RESULT_KEYS] + [f"$[0].{k}" for k in SEARCH_RESULT_KEYS]
    picks = F.transform("_srv", lambda v: first_nonempty(*[string_at(v, p) for p in walk_paths]))
    if "_sr" in text:
        picks = F.coalesce(F.when(F.col("_sr_ok"), picks), again("_sr", _OBJECT, _walk_repeated(cols["_sr"], SEARCH_RESULT_KEYS)))
    tier = {
        "_t1": typed["_ep"].list_pick(ENTITY_PAGE_KEYS) if "_ep" in typed else first_nonempty(*s["ep"]),
        "_t2": (F.coalesce(typed["_ev"].list_string(), typed["_ev"].list_pick(EVIDENCE_KEYS)) if "_ev" in typed
                else F.coalesce(*s["ev0"], first_nonempty(*s["ev"]))),
        "_t3": typed["_sr"].list_pick(SEARCH_RESULT_KEYS) if "_sr" in typed else first_nonempty(*s["sr"])}
    walked = typed["_sr"].walk(SEARCH_RESULT_KEYS) if "_sr" in typed else picks
    x = x.select(*keep, *[py_trim(c).alias(k) for k, c in tier.items()],
                 F.filter(F.transform(walked, py_trim), lambda t: t != F.lit("")).alias("_t4"))
    ctx = F.coalesce(_blank_to_null(F.col("_t1")), _blank_to_null(F.col("_t2")), _blank_to_null(F.col("_t3")),
                     F.try_element_at(F.col("_t4"), F.lit(1)), F.lit(placeholder))
    return x.select(*keep, ctx.alias(name))


def context_fields(df: DataFrame, fields=("entity_pages", "evidence", "search_results")) -> DataFrame:
    """A tally of JSON-text columns, a row a field: n_rows, n_missing (null),
    n_json, n_repeated_keys (read by the tolerant parse) and n_unparsable."""
    def counts(c):
        text = F.col(c)
        parsed = F.try_parse_json(text).isNotNull()
        lists = text.rlike(_LIST) & F.from_json(text, "array<string>", _STRICT).isNotNull()
        objects = text.rlike(_OBJECT) & F.from_json(text, "map<string,string>", _STRICT).isNotNull()
        state = F.when(text.isNull(), "missing").when(parsed, "json").when(lists | objects, "repeated_keys").otherwise("unparsable")
        return F.struct(F.lit(c).alias("field"), state.alias("state"))
    states = df.select(F.explode(F.array(*[counts(c) for c in fields])).alias("f")).select("f.field", "f.state")
    n = lambda state: F.count_if(F.col("state") == state)
    return states.groupBy("field").agg(F.count(F.lit(1)).alias("n_rows"), n("missing").alias("n_missing"), n("json").alias("n_json"),
                                       n("repeated_keys").alias("n_repeated_keys"), n("unparsable").alias("n_unparsable"))
