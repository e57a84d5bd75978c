"""Bilingual text of a property and the key under which like ones are one search result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brickwork.functions import text

# Arabic renderings.
FLOOR_AR = {"penthouse": "بنتهاوس", "duplex": "دوبلكس", "roof": "روف", "garden": "جاردن", "ground": "أرضي", "corner": "كورنر", "typical": "دور متكرر"}
VIEW_AR = {"sea": "فيو بحر", "lagoon": "فيو لاجون", "golf": "فيو جولف", "club": "كلوب هاوس", "landscape": "لاند سكيب"}
FURNISHING_AR = {"furnished": "مفروش", "unfurnished": "غير مفروش", "partly furnished": "مفروش جزئيا", "semi-furnished": "نصف مفروش"}
COMPLETION_AR = {"ready": "جاهز للتسليم", "completed": "مكتمل البناء", "off-plan": "تحت الإنشاء / على الخريطة", "under construction": "قيد الإنشاء"}


def _rendered(value: Column, names: dict[str, str]) -> Column:
    out = value
    for k, v in names.items():
        out = F.when(F.lower(F.trim(value)) == k, v).otherwise(out)
    return out


def _given(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _number(value: Column) -> Column:
    return F.when(value != 0, value)


def arabic_segment(title: Column, furnishing: Column, completion: Column, compose: bool = True) -> Column:
    n = text.normalise(title, compose)
    floor, view, phase, building, garden, ground = (c for c in text.signals(n))
    details = F.array_compact(F.array(F.when(garden & ground, F.lit("أرضي بجاردن")).otherwise(_rendered(floor, FLOOR_AR)), _rendered(view, VIEW_AR), F.concat(F.lit("بلوك "), building), F.concat(F.lit("مرحلة "), phase), _rendered(_given(furnishing), FURNISHING_AR), _rendered(_given(completion), COMPLETION_AR)))
    return F.when(_given(title).isNotNull(), F.concat_ws(" — ", title, F.when(F.size(details) > 0, F.concat(F.lit("وحدة: "), F.array_join(details, "، ")))))


def document(compose: bool = True) -> Column:
    """The document of a row of property_features. The sentences."""
    c = F.col
    whole = lambda x: F.format_number(x, 0)  # noqa: E731  half to even, with thousands separators
    plain = lambda x: F.regexp_replace(F.format_number(x, 0), ",", "")
    header = F.concat(F.coalesce(_given(c("property_type")), F.lit("Property")), F.coalesce(F.concat(F.lit(" with "), _number(c("rooms")).cast("bigint"), F.lit(" rooms")), F.lit("")), F.coalesce(F.concat(F.lit(" and "), _number(c("baths")).cast("bigint"), F.lit(" bathrooms")), F.lit("")), F.coalesce(F.concat(F.lit(", "), plain(_number(c("area_m2"))), F.lit(" square meters")), F.lit("")), F.lit("."))
    place = F.concat_ws(", ", _given(c("neighbourhood")), _given(c("city")), _given(c("province")))
    status = F.concat_ws(", ", F.concat(text.title_case(_given(c("furnishing_status"))), F.lit(" furnishing")), F.concat(text.title_case(_given(c("completion_status"))), F.lit(" status")))
    average, per_m2 = c("neighbourhood_avg_price_per_m2"), _number(c("price_per_m2"))
    change = (per_m2 - average) / F.when(average > 0, average) * 100
    against = F.when(F.abs(change) >= 5, F.concat(F.lit(" ("), plain(F.abs(change)), F.when(change > 0, F.lit("% above")).otherwise(F.lit("% below")), F.lit(" neighbourhood average of "), whole(average), F.lit(" EGP/m²).")))
    return F.concat_ws(
        " ",
        arabic_segment(c("representative_title"), c("furnishing_status"), c("completion_status"), compose),
        header,
        F.when(place != "", F.concat(F.lit("Located in "), place, F.lit("."))),
        F.when(status != "", F.concat(F.lit("Status: "), status, F.lit("."))),
        F.concat(F.lit("Listed by "), _given(c("agency_name")), F.lit(".")),
        F.concat(F.lit("Listed at "), whole(_number(c("price_egp"))), F.lit(" EGP.")),
        F.concat(F.lit("That's about "), whole(per_m2), F.lit(" EGP per square meter."), F.coalesce(against, F.lit(""))),
        F.concat(F.lit("On market for "), c("days_on_market"), F.lit(" days.")),
        F.when(c("is_outlier"), F.lit("Note: this price is a statistical outlier compared to similar properties.")),
        F.concat(F.lit("URL: "), _given(c("url"))),
    )


def dedup_key() -> Column:
    """city|neighbourhood|type|rooms|area, the area to the nearest ten, half to even."""
    c = F.col
    rooms = F.coalesce(F.when(c("rooms") != 0, F.format_string("%s", c("rooms").cast("string"))), F.lit(""))
    area = (F.bround(F.coalesce(c("area_m2"), F.lit(0.0)) / 10) * 10).cast("bigint").cast("string")
    return F.concat_ws("|", *[F.coalesce(c(x), F.lit("")) for x in ("city", "neighbourhood", "property_type")], rooms, area)
