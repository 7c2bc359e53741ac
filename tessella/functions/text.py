"""Native string expressions: names, units, paths and the fixed tables they use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered rules, the first that matches names the measurement.
CANONICAL_RULES = [
    (r"\b(lvef|ef|ejection fraction)\b", "left_ventricular_ejection_fraction"),
    (r"\b(lvedv|lv end diastolic volume|lv edv)\b", "left_ventricular_end_diastolic_volume"),
    (r"\b(lvesv|lv end systolic volume|lv esv)\b", "left_ventricular_end_systolic_volume"),
    (r"\b(lvedd|lvidd|lv end diastolic diameter|lv internal diameter diastole)\b", "left_ventricular_end_diastolic_diameter"),
    (r"\b(lvesd|lvids|lv end systolic diameter|lv internal diameter systole)\b", "left_ventricular_end_systolic_diameter"),
    (r"\b(ivsd|ivs diastolic|septal thickness diastole)\b", "interventricular_septum_diastolic_thickness"),
    (r"\b(lvpwd|posterior wall diastolic|pw diastolic)\b", "left_ventricular_posterior_wall_diastolic_thickness"),
    (r"\b(la volume index|lavi)\b", "left_atrial_volume_index"),
    (r"\b(la volume)\b", "left_atrial_volume"),
    (r"\b(la area)\b", "left_atrial_area"),
    (r"\b(ra area)\b", "right_atrial_area"),
    (r"\b(ra pressure|rap)\b", "right_atrial_pressure"),
    (r"\b(rvsp)\b", "right_ventricular_systolic_pressure"),
    (r"\b(pasp)\b", "pulmonary_artery_systolic_pressure"),
    (r"\b(tr v max|tr velocity|tr jet velocity)\b", "tricuspid_regurgitant_peak_velocity"),
    (r"\b(e\/e('| prime)?|e e prime)\b", "mitral_inflow_to_annular_velocity_ratio"),
    (r"\b(mitral e velocity|mv e)\b", "mitral_e_velocity"),
    (r"\b(mitral a velocity|mv a)\b", "mitral_a_velocity"),
    (r"\b(mitral e a ratio|mv e a)\b", "mitral_e_a_ratio"),
    (r"\b(av peak gradient|aortic valve peak gradient)\b", "aortic_valve_peak_gradient"),
    (r"\b(av mean gradient|aortic valve mean gradient)\b", "aortic_valve_mean_gradient"),
    (r"\b(av area|aortic valve area)\b", "aortic_valve_area"),
    (r"\b(mv mean gradient|mitral valve mean gradient)\b", "mitral_valve_mean_gradient"),
    (r"\b(mv area|mitral valve area)\b", "mitral_valve_area"),
    (r"\b(tapse)\b", "tricuspid_annular_plane_systolic_excursion"),
    (r"\b(s prime|s')\b", "tissue_doppler_systolic_velocity"),
    (r"\b(gls|global longitudinal strain)\b", "global_longitudinal_strain"),
    (r"\b(aortic root)\b", "aortic_root_diameter"),
    (r"\b(ascending aorta)\b", "ascending_aorta_diameter"),
    (r"\b(lv mass index)\b", "left_ventricular_mass_index"),
    (r"\b(lv mass)\b", "left_ventricular_mass"),
]

# Spellings of each unit.
UNIT_SPELLINGS = {
    "percent": "%",
    "percentage": "%",
    "%": "%",
    "mm": "mm",
    "millimeter": "mm",
    "millimeters": "mm",
    "cm": "cm",
    "centimeter": "cm",
    "centimeters": "cm",
    "m": "m",
    "meter": "m",
    "meters": "m",
    "mmhg": "mmhg",
    "mm hg": "mmhg",
    "cmh2o": "cmh2o",
    "cm h2o": "cmh2o",
    "ml": "ml",
    "milliliter": "ml",
    "milliliters": "ml",
    "l": "l",
    "liter": "l",
    "liters": "l",
    "m/s": "m/s",
    "m / s": "m/s",
    "m per s": "m/s",
    "m per sec": "m/s",
    "m/sec": "m/s",
    "m second": "m/s",
    "m s": "m/s",
    "m sec": "m/s",
    "cm/s": "cm/s",
    "cm / s": "cm/s",
    "cm per s": "cm/s",
    "cm per sec": "cm/s",
    "cm/sec": "cm/s",
    "cm second": "cm/s",
    "cm s": "cm/s",
    "cm sec": "cm/s",
    "m2": "m2",
    "m^2": "m2",
    "cm2": "cm2",
    "cm^2": "cm2",
    "ml/m2": "ml/m2",
    "ml/m^2": "ml/m2",
    "bpm": "bpm",
    "beats/min": "bpm",
    "ms": "ms",
    "s": "s",
    "sec": "s",
    "seconds": "s",
    "ratio": "ratio",
    "unitless": "ratio",
}

# Category, canonical unit and factor of each unit.
UNITS = {
    "%": ("fraction", "%", 1.0),
    "ratio": ("fraction", "ratio", 1.0),
    "mm": ("length", "mm", 1.0),
    "cm": ("length", "mm", 10.0),
    "m": ("length", "mm", 1000.0),
    "cm2": ("area", "cm2", 1.0),
    "m2": ("area", "cm2", 10000.0),
    "ml": ("volume", "ml", 1.0),
    "l": ("volume", "ml", 1000.0),
    "ml/m2": ("indexed_volume", "ml/m2", 1.0),
    "m/s": ("velocity", "cm/s", 100.0),
    "cm/s": ("velocity", "cm/s", 1.0),
    "mmhg": ("pressure", "mmhg", 1.0),
    "cmh2o": ("pressure", "cmh2o", 1.0),
    "bpm": ("rate", "bpm", 1.0),
    "ms": ("time", "ms", 1.0),
    "s": ("time", "ms", 1000.0),
}

# Names that would leak the ejection fraction into features.
LEAKAGE_PATTERNS = [
    r"^lvef$", r"^ef$", r"^ejection.?fraction", r"^lv.?ef", r"^lv_ef", r"^lvef_", r"^biplane.*ef", r"^simpson.*ef",
    r"^mod.*a[24]c.*ef", r"^teich.*ef", r"^lv_systolic_function", r"^lv.*function.*grade", r"^visual.*ef", r"^ef_", r"^fractional.?shortening", r"^lv.?fs",
]

# Rewrites of a unit's spelling, in this order (so "centimeter^2" is met as "meter^2").
UNIT_REWRITES = [
    ("per second", "per sec"), ("meters", "meter"), ("centimeters", "centimeter"), ("millimeters", "millimeter"),
    ("square meter", "m2"), ("square centimeter", "cm2"), ("meter^2", "m2"), ("centimeter^2", "cm2"),
]


def _map(pairs: dict[str, str | float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def norm_text(c: Column, keep_hyphen: bool = False) -> Column:
    """Lower case, ``_`` and ``/`` as spaces, other characters dropped to spaces; null is empty.

    ``keep_hyphen`` keeps ``-`` and squeezes spaces (the panel's variant).  Without
    it (the registry's variant) ``-`` becomes a space, runs of spaces stay, and a
    backslash with any ``s`` after it becomes one space.
    """
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), "[_/]+", " ")
    if keep_hyphen:
        return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9%+\-\s]", " "), r"\s+", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9%+\\]", " "), r"\\s+", " "))


def norm_unit(c: Column) -> Column:
    """The unit's symbol, ``unknown`` for null or nothing, an unlisted spelling as it is."""
    t = F.translate(F.lower(F.trim(c)), "μµ", "uu")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9/%^.\s]", " "), r"\s+", " "))
    t = reduce(lambda x, ab: F.replace(x, F.lit(ab[0]), F.lit(ab[1])), UNIT_REWRITES, t)
    known = _map(UNIT_SPELLINGS)
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit("unknown")).otherwise(F.coalesce(F.element_at(known, t), F.when(t.contains("%"), F.lit("%")), t))


def unit_category(unit: Column) -> Column:
    return F.coalesce(F.element_at(_map({u: v[0] for u, v in UNITS.items()}), unit), F.lit("unknown"))


def canonical_unit(unit: Column) -> Column:
    """The unit values are compared in; ``unknown`` for an unlisted unit."""
    return F.coalesce(F.element_at(_map({u: v[1] for u, v in UNITS.items()}), unit), F.lit("unknown"))


def unit_factor(unit: Column) -> Column:
    return F.coalesce(F.element_at(_map({u: v[2] for u, v in UNITS.items()}), unit), F.lit(1.0))


def canonical_name(name: Column, description: Column, manual: dict[str, str] | None = None) -> Column:
    """``struct(canonical, source)`` of normalised texts: manual map, ordered rules, then the name itself."""
    hay = F.trim(F.concat_ws(" ", name, description))
    fallback = F.regexp_replace(F.regexp_replace(F.replace(name, F.lit(" "), F.lit("_")), "_+", "_"), "^_|_$", "")
    named = F.struct(F.when(fallback == "", F.lit("unknown_measurement")).otherwise(fallback).alias("canonical"), F.lit("fallback").alias("source"))
    out = named
    for pattern, canonical in reversed(CANONICAL_RULES):
        out = F.when(hay.rlike(pattern), F.struct(F.lit(canonical).alias("canonical"), F.lit("auto_rule").alias("source"))).otherwise(out)
    if manual:
        given = F.element_at(_map(manual), name)
        out = F.when(given.isNotNull(), F.struct(given.alias("canonical"), F.lit("manual").alias("source"))).otherwise(out)
    return out


def is_leakage(name: Column) -> Column:
    return F.coalesce(F.lower(F.trim(name)).rlike("|".join(LEAKAGE_PATTERNS)), F.lit(False))


def column_name(c: Column, prefix: str = "task__") -> Column:
    """A column name of word characters, runs of ``_`` squeezed and cut from the ends."""
    t = F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9_]+", "_"), "_+", "_")
    return F.concat(F.lit(prefix), F.regexp_replace(t, "^_|_$", ""))


def try_double(c: Column) -> Column:
    """A number in plain notation, null for anything else (also ``NaN``, ``5d``, ``1_000``)."""
    return F.when(c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), F.trim(c).try_cast("double"))


def as_boolean(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("1", "true", "yes", "y", "t"), F.lit(False))


def boolean_or_error(c: Column) -> Column:
    """The same words and their opposites; any other text is an error, null stays."""
    t = F.lower(F.trim(c))
    other = F.raise_error(F.concat(F.lit("no boolean: "), c)).cast("boolean")
    return F.when(t.isin("1", "true", "yes", "y", "t"), F.lit(True)).when(t.isin("0", "false", "no", "n", "f"), F.lit(False)).when(c.isNotNull(), other)


def listed_bytes(c: Column) -> Column:
    """The bytes of a storage listing's total line, ``<bytes>  gs://...``; null for any other line."""
    return F.regexp_extract(c, r"^\s*(\d+)\s+gs://", 1).try_cast("long")


def relative_path(c: Column) -> Column:
    return F.regexp_replace(c, "^/+", "")


def join_url(base: str, path: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), relative_path(path))


def study_dir(subject: Column, study: Column, unit: int = 1_000_000) -> Column:
    return F.format_string("files/p%02d/p%d/s%d", F.floor(subject / unit).cast("long"), subject, study)


def rewrite_prefix(c: Column, old: str, new: str) -> Column:
    """``new`` in place of a leading ``old``; both must be given, or neither."""
    if bool(old) != bool(new):
        raise ValueError("give both prefixes or neither")
    return F.when(c.startswith(old), F.concat(F.lit(new), F.substr(c, F.lit(len(old) + 1)))).otherwise(c) if old else c


def bucket_and_key(c: Column) -> Column:
    """``struct(bucket, key)`` of ``gs://bucket/key``."""
    return F.struct(F.regexp_extract(c, "^gs://([^/]+)/?", 1).alias("bucket"), F.regexp_extract(c, "^gs://[^/]+/?(.*)$", 1).alias("key"))


def swap_suffix(c: Column, suffix: str) -> Column:
    """A file name with another suffix in place of its last one."""
    return F.concat(F.regexp_replace(c, r"\.[^./]*$", ""), F.lit(suffix))


def frame_name(c: Column, index: Column) -> Column:
    """The picture of one frame of a clip: ``stem_f007.png``."""
    return F.concat(F.regexp_replace(F.regexp_extract(c, "([^/]*)$", 1), r"\.[^.]*$", ""), F.format_string("_f%03d.png", index))


def up_to(c: Column, marker: str) -> Column:
    """The text up to and with the first ``marker``; null where it is absent."""
    at = F.locate(marker, c)
    return F.when(at > 0, F.substr(c, F.lit(1), at + (len(marker) - 1)))
