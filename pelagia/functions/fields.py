"""Scalar functions over names, units, depths and cell values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagia.schema import DEFAULT_SCALE, SCALE_FACTORS

# Fixed values, here and where a pattern or spelling stands in a function below: the names of members, scenarios, files and months, the
# spellings of units, and what stands for no data, all as the archives and products have them.
MEMBER = "^r[0-9]+i[0-9]+p[0-9]+f[0-9]+$"
SCENARIO = "^(historical|ssp[0-9]{3})$"
MONTH = "^(?:.*/)?(?:(?![0-9]{6})[^/])*([0-9]{4}(?:0[1-9]|1[0-2]))[^/]*\\.nc$"
NODATA = {"int16": -32768, "int32": -2147483648}


def filled(text: Column, other: str) -> Column:
    """text, or other where it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(other))


def sanitize_units(units: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(filled(F.trim(units), "unitless"), " ", ""), "/", "per")
    return filled(F.regexp_replace(bare, "[^A-Za-z0-9+-]", ""), "unitless")


def normalize_units(units: Column) -> Column:
    return F.replace(F.replace(F.replace(F.lower(units), F.lit("_"), F.lit(" ")), F.lit("**"), F.lit("^")), F.lit(" "), F.lit(""))


def depth_token(depth: Column) -> Column:
    """5.079 -> 0005p079m.  Ties of the third decimal are rounded half up on the shortest decimal form."""
    parts = F.split(F.abs(depth).cast("decimal(12,3)").cast("string"), "\\.")
    sign = F.when(depth < 0, "m").otherwise("")
    return F.concat(sign, F.lpad(parts[0], 4, "0"), F.lit("p"), parts[1], F.lit("m"))


def depth_of_name(name: Column) -> Column:
    """The depth in a name's token, or NULL."""
    whole, part = (F.regexp_extract(name, "_depth_([0-9]+)p([0-9]+)m", g) for g in (1, 2))
    return F.when(whole != "", F.concat(whole, F.lit("."), part).cast("double"))


def depth_label(name: Column, label: Column, lower: Column, upper: Column, depth: Column) -> Column:
    """Layer or zone in the name; the bin's own label or bounds; a scalar depth; a depth in the name.  NULL for 2-D data."""
    layer = F.regexp_extract(name, "(?:layer|zone)_((?:[a-z]+_)?[0-9]{4}_[0-9]{4}m)", 1)
    bounds = F.concat(lower.cast("string"), F.lit("-"), upper.cast("string"))
    return F.coalesce(F.nullif(layer, F.lit("")), F.nullif(label, F.lit("")), bounds, depth.cast("string"), depth_of_name(name).cast("string"))


def cmip_parts(name: Column) -> dict[str, Column]:
    """<var>_<table>_<model>_<scenario>_<member>_<grid>_<range>: the fields, and whether they are valid."""
    base = F.regexp_replace(F.regexp_replace(name, "^.*/", ""), "\\.nc$", "")
    parts = F.split(base, "_")
    names = ("variable", "table_id", "model", "scenario", "member", "grid_label", "time_range")
    out = {n: F.try_element_at(parts, F.lit(i + 1)) for i, n in enumerate(names)}
    full = F.lit(True)
    for n in names[:-1]:
        full = full & (F.coalesce(out[n], F.lit("")) != "")
    return out | {"is_valid": full & F.coalesce(out["member"].rlike(MEMBER) & out["scenario"].rlike(SCENARIO), F.lit(False))}


def member_of_product(name: Column, model: Column, scenario: Column, variable: Column) -> Column:
    """ipcc_esgf_<model>_<scenario>_<member>_<var>_...: the member, or NULL."""
    base, head = F.regexp_replace(name, "^.*/", ""), F.concat(F.lit("ipcc_esgf_"), model, F.lit("_"), scenario, F.lit("_"))
    rest = F.when(F.startswith(base, head), F.substring(base, F.length(head) + 1, F.length(base)))
    mark = F.concat(F.lit("_"), variable, F.lit("_"))
    found = F.when(F.contains(rest, mark), F.split_part(rest, mark, F.lit(1)))
    return F.when(found.rlike(MEMBER), found)


def cesm_member(name: Column) -> Column:
    first, second = F.regexp_extract(name, "\\.([0-9]{3})\\.pop\\.", 1), F.regexp_extract(name, "f09_g16\\.([0-9]{3})\\.", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")), F.lit("unknown_member"))


def month_of_name(name: Column, pattern: str = MONTH) -> Column:
    """The month (YYYYMM) in a file's name, or NULL: the first six digits of a .nc file's name when they end in a month.

    Another pattern tells by its first group where else names have it; names that it doesn't match have none.
    """
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))


def time_range(name: Column) -> tuple[Column, Column]:
    """First and last day of _YYYY[MM]-YYYY[MM].nc; a missing month is January or December.  NULLs without such a range."""
    pattern = "_([0-9]{4})([0-9]{2})?[0-9]*-([0-9]{4})([0-9]{2})?[0-9]*\\.nc$"
    y0, m0, y1, m1 = (F.regexp_extract(name, pattern, g) for g in (1, 2, 3, 4))
    day = lambda y, m: F.try_to_timestamp(F.concat(y, F.lit("-"), m, F.lit("-01"))).cast("date")
    return F.when(y0 != "", day(y0, filled(m0, "01"))), F.when(y1 != "", F.last_day(day(y1, filled(m1, "12"))))


def member_order(member: Column) -> Column:
    """(r, i, p, f) as numbers; ids of another form come last."""
    number = lambda g: F.regexp_extract(member, "^r([0-9]+)i([0-9]+)p([0-9]+)f([0-9]+)$", g).try_cast("int")
    return F.struct(*[F.coalesce(number(g), F.lit(2147483647)).alias(n) for g, n in enumerate("ripf", 1)], member.alias("id"))


def scale_factor(path: Column) -> Column:
    """The integer scale of the first known variable among a path's tokens."""
    key = F.try_element_at(F.filter(F.split(F.lower(path), "[/_.-]+"), lambda t: t.isin(*SCALE_FACTORS)), F.lit(1))
    out = F.lit(DEFAULT_SCALE)
    for name, scale in SCALE_FACTORS.items():
        out = F.when(key == name, F.lit(scale)).otherwise(out)
    return out


def encoded(value: Column, scale: Column) -> Column:
    """rint(value * scale), half to even; NULL stays NULL."""
    return F.rint(value * scale)


def encoded_dtype(low: Column, high: Column) -> Column:
    """int16 while the encoded range fits beside its nodata value, else int32; beyond that an error."""
    fits = lambda n: (F.coalesce(low, F.lit(0.0)) > NODATA[n]) & (F.coalesce(high, F.lit(0.0)) <= -(NODATA[n] + 1))
    return F.when(fits("int16"), "int16").when(fits("int32"), "int32").otherwise(F.raise_error(F.lit("values are beyond 32 bits at this scale")))


def converted_velocity(value: Column, product: Column, scenario: Column, model: Column, variable: Column, path: Column) -> tuple[Column, Column]:
    """Centimetres a second to metres for the one series delivered in those; (value, conversion note)."""
    applies = (product == "future") & (scenario == "rcp85") & (model == "cesm_f09_g16") & (variable == "uo") & F.contains(F.lower(path), F.lit("uvel"))
    return F.when(applies, value / 100).otherwise(value), F.when(applies, "cm s-1 to m s-1").otherwise("")


def csv_safe(text: Column) -> Column:
    return F.regexp_replace(text, "[\\r\\n]+", " ")


#: Factors from the unit of a source's depths to that of the reference's.
DEPTH_FACTORS = {"cm:m": 0.01, "m:m": 1.0, "none:m": 1.0, "none:none": 1.0, "m:none": 1.0}


def depth_factor(source: Column, target: Column) -> Column:
    """The factor that turns depths in one unit into another; a pair without one is an error, a missing unit counts as none."""
    pair = F.concat_ws(":", F.coalesce(F.nullif(F.trim(source), F.lit("")), F.lit("none")), F.coalesce(F.nullif(F.trim(target), F.lit("")), F.lit("none")))
    out = F.raise_error(F.concat(F.lit("no factor between depth units "), pair)).cast("double")
    for known, factor in DEPTH_FACTORS.items():
        out = F.when(pair == known, F.lit(factor)).otherwise(out)
    return out
