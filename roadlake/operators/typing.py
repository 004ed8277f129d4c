"""Records to typed, flat rows: extraction by declared path, coercion, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions import scalars as S
from roadlake.operators.decode import once
from roadlake.schema import Field, Schema, snake


def leaf(field: Field, at: Members) -> Column:
    """The variant of a field: by its wire path, else by the same path in snake_case; a reference may be a bare string."""
    found = along(field, at, field.path)
    own = tuple(map(snake, field.path))
    if field.reference is None and len(field.path) == 1 and own != (field.name,) and "__" not in field.name:
        return F.coalesce(found, along(field, at, own), along(field, at, (field.name,)))
    return found if own == field.path else F.coalesce(found, along(field, at, own))


def along(field: Field, at: Members, path: tuple[str, ...]) -> Column:
    if field.reference is None:
        return at.get(*path)
    holder, rest = at.get(*path[: field.reference + 1]), path[field.reference + 1 :]
    whole = S.get(holder, *rest)
    return F.when(S.shape(holder) == "STRING", holder if rest == ("id",) else F.lit(None).cast("variant")).otherwise(whole)


class Members:
    """A record's members that the paths of a schema begin with, all taken in one pass over the record as ``_members``, a
    struct of variants: a path looked up in the record searches it once more for each column."""

    def __init__(self, schema: Schema) -> None:
        keys: dict[str, str] = {}
        for f in schema.fields:
            for key in (f.path[0], snake(f.path[0]), f.name if len(f.path) == 1 else f.path[0]):
                keys.setdefault(key.lower(), key)  # a struct's names differ by more than small and capital letters
        self.keys = set(keys.values())

    def struct(self, record: Column) -> Column:
        return F.try_variant_get(record, "$", f"struct<{','.join(f'`{k}`:variant' for k in sorted(self.keys))}>")

    def get(self, *path: str) -> Column:
        """The variant at a path of the record."""
        if path[0] not in self.keys:
            return S.get(F.col("record"), *path)
        member = F.col("_members").getField(path[0])
        return S.get(member, *path[1:]) if path[1:] else member


def around(path: tuple[str, ...], at: Members) -> Column:
    """Whether the record has an object at ``path``, or at the same path in snake_case."""
    own = tuple(map(snake, path))
    block = at.get(*path) if own == path else F.coalesce(at.get(*path), at.get(*own))
    return block.isNotNull() & S.is_object(block)


def source_of(field: Field, at: Members) -> Column:
    """The field's variant from the columns of decode.records: a stamp first, then the record, then the identity."""
    found = leaf(field, at)
    key = field.path[0]
    if len(field.path) == 1:
        stamp = F.when(F.col("stamped")[key].isNotNull(), F.to_variant_object(F.array(F.col("stamped")[key])))
        found = F.coalesce(F.try_variant_get(stamp, "$[0]", "variant"), found, F.col("identity")[key])
    return found


def value_of(field: Field, raw: Column, known: Column, text: Column | None = None) -> Column:
    """The typed value: coerced; text stripped, an empty one null (elements of lists keep it). ``text``: the field's, as
    scalars.written() gives it."""
    if field.lift == "idlist":
        return S.id_list(raw)
    if field.array:
        items = F.try_variant_get(raw, "$", "array<variant>")
        typed = F.transform(items, lambda x: S.coerced(x, field.scalar))
        return F.when(F.startswith(known, F.lit("ARRAY")) & ~F.exists(typed, lambda x: x.isNull()), typed)
    if field.lift == "emptyint":
        return F.when(S.text_of(raw, known) == "", F.lit(None)).otherwise(S.coerced(raw, field.scalar, None, known, text))
    return S.coerced(raw, field.scalar, field.lift, known, text)


def fault_of(field: Field, known: Column, blank: Column, value: Column, block: Column | None) -> Column:
    """"path: kind of error", or null; never a value."""
    name = ".".join(field.path)
    absent = known.isNull() | (known == "VOID")
    out = F.when(~absent & ~blank & value.isNull(), F.lit(f"{name}: no {field.kind}{' ' + field.lift if field.lift else ''}"))
    if field.enum:
        out = out.when(~absent & ~value.isin(*field.enum), F.lit(f"{name}: not in the closed set"))
    if field.required == "!":
        out = out.when(absent, F.lit(f"{name}: missing"))
    elif block is not None:
        out = out.when(absent & block, F.lit(f"{name}: missing"))
    return out


def typed(records: DataFrame, schema: Schema, keep: list[str] | None = None) -> DataFrame:
    """A row per record: the columns of ``schema`` and ``errors`` (array of texts, empty for a valid record), after those of
    ``keep``. Keys that are not declared are dropped. Zero records give zero rows of the same columns.

    Each step makes what the next one uses several times: a field's variant, its type, its text, its value, its fault. The last is
    kept by ``once`` from being made again in filters on errors.
    """
    keep, fields = keep or [], list(enumerate(schema.fields))
    paths = list(dict.fromkeys(f.path[:-1] for f in schema.fields if f.required == "(!)"))
    column = lambda name: lambda k: F.col(f"_{name}_{k}")
    raw, known, text, value, blank, block = map(column, ("raw", "known", "text", "value", "blank", "block"))
    reads_text = lambda f: not f.array and f.lift not in ("idlist", "epochms")
    at = Members(schema)
    blocks = [around(p, at).alias(f"_block_{j}") for j, p in enumerate(paths)]
    rows = records.select("*", at.struct(F.col("record")).alias("_members"))
    rows = rows.select(*keep, *[source_of(f, at).alias(f"_raw_{k}") for k, f in fields], *blocks)
    rows = rows.select("*", *[S.shape(raw(k)).alias(f"_known_{k}") for k, _ in fields])
    blanks = [(S.text_of(raw(k), known(k)) == "").alias(f"_blank_{k}") for k, f in fields if f.lift == "emptyint"]
    rows = rows.select("*", *blanks, *[S.written(raw(k), f.lift, known(k)).alias(f"_text_{k}") for k, f in fields if reads_text(f)])
    rows = rows.select(*keep, *[block(j) for j in range(len(paths))], *[known(k) for k, _ in fields], *[blank(k) for k, f in fields if f.lift == "emptyint"], *[value_of(f, raw(k), known(k), text(k) if reads_text(f) else None).cast(f.spark).alias(f"_value_{k}") for k, f in fields])
    # without nulls; no two faults have one text
    faults = [fault_of(f, known(k), F.coalesce(blank(k), F.lit(False)) if f.lift == "emptyint" else F.lit(False), value(k), block(paths.index(f.path[:-1])) if f.required == "(!)" else None) for k, f in fields]
    errors = F.array_except(F.array(*faults), F.array(F.lit(None).cast("string")))
    shown = lambda f, k: F.nullif(value(k), F.lit("")) if f.kind == "STRING" else value(k)
    rows = rows.select(*keep, *[shown(f, k).alias(f.name) for k, f in fields], errors.alias("_errors"))
    return rows.select(*keep, *[f.name for f in schema.fields], once(F.col("_errors")).alias("errors"))


def valid(rows: DataFrame, strict: bool = True) -> DataFrame:
    """Typed rows without ``errors``. ``strict``: a row with errors fails the job that meets it, as a batch with one bad
    record is refused whole; otherwise such rows are left out (quarantined() has them)."""
    if strict:
        fine = F.when(F.size("errors") == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("record refused: "), F.concat_ws("; ", "errors"))).cast("boolean"))
        return rows.where(fine).drop("errors")
    return rows.where(F.size("errors") == 0).drop("errors")


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("errors") > 0)


def error_counts(rows: DataFrame) -> DataFrame:
    """error, n: how many records each kind of error refused."""
    return rows.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


def empty_to_null(rows: DataFrame) -> DataFrame:
    """Empty text of every text column as null; elements of lists stay."""
    return rows.select(*[F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in rows.dtypes])
