"""Places in free text to regions, and whether a journey between two regions is plausible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from khayt.functions import arabic as A
from khayt.functions.segment import normal

# Regions from west to east, by zones of travel, the one that all roads lead to, and the forms in which their places are written.
ZONES = {"andalus": 0, "maghrib": 1, "egypt": 2, "sham": 3, "hijaz": 3, "yemen": 3, "iraq": 4, "jibal": 5, "fars": 5, "khurasan": 6, "transoxiana": 7}
HUBS = ("hijaz",)
MOST_ZONES = 4
PLACES = {
    "hijaz": "hijaz, الحجاز, mecca, makka, makkah, bakkah, مكة, medina, madina, madinah, yathrib, المدينة, المدينه, taif, الطائف",
    "iraq": "iraq, العراق, kufa, kufah, الكوفة, الكوفه, basra, basrah, البصرة, البصره, baghdad, madinat al-salam, بغداد, wasit, واسط, mosul, mawsil, الموصل",
    "sham": "sham, syria, الشام, damascus, dimashq, دمشق, homs, hims, حمص, aleppo, halab, حلب, jerusalem, quds, bayt al-maqdis, القدس",
    "egypt": "egypt, misr, مصر, fustat, الفسطاط, cairo, qahira, القاهرة, alexandria, iskandariyya, الإسكندرية, الاسكندرية",
    "yemen": "yemen, yaman, اليمن, sanaa, sana, صنعاء, aden, عدن",
    "khurasan": "khurasan, khorasan, خراسان, nishapur, naysabur, نيسابور, merv, marw, مرو, herat, harat, هراة, balkh, بلخ",
    "transoxiana": "transoxiana, ma wara al-nahr, ما وراء النهر, bukhara, بخارى, samarqand, samarkand, سمرقند",
    "jibal": "jibal, الجبال, rayy, الري, isfahan, isbahan, أصفهان, اصفهان, hamadan, hamadhan, همذان, qom, qum, قم",
    "fars": "fars, persia, فارس, shiraz, شيراز",
    "maghrib": "maghrib, المغرب, qayrawan, kairouan, القيروان, fes, fez, فاس",
    "andalus": "andalus, الأندلس, الاندلس, cordoba, qurtuba, قرطبة, seville, ishbiliyya, إشبيلية",
}


def _key(text: Column) -> Column:
    """A place as it is looked up: Arabic normalised, Latin in lower case without its article."""
    latin = F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), r"^[ae]l[- ]", "")
    return F.when(A.is_arabic(text), A.normalize_arabic(text)).otherwise(latin)


def region(place: Column) -> Column:
    """The region a place lies in, by the whole text or else by its first word that is a known place; null where nothing is known."""
    known = F.create_map(*[F.lit(x) for name, forms in PLACES.items() for form in dict.fromkeys(normal(f) for f in forms.split(", ")) for x in (form, name)])
    whole = _key(place)
    words = F.transform(F.split(F.regexp_replace(whole, "[,/]", " "), r"\s+"), lambda w: F.try_element_at(known, _key(w)))
    return F.coalesce(F.try_element_at(known, whole), F.get(F.array_compact(words), F.lit(0)))


def travel_ok(a: Column, b: Column, most: int = MOST_ZONES) -> Column:
    """Whether a journey between two regions is plausible; an unknown region or a hub is no hindrance."""
    zones = F.create_map(*[F.lit(x) for k, v in ZONES.items() for x in (k, v)])
    return F.coalesce(a.isin(*HUBS) | b.isin(*HUBS) | (F.abs(F.try_element_at(zones, a) - F.try_element_at(zones, b)) <= most), F.lit(True))


def travel_ok_with_any(a: Column, others: Column) -> Column:
    """Whether a journey from a region to one of several is plausible: yes where none of them, or not the region itself, is known."""
    known = F.array_compact(others)
    return a.isNull() | (F.size(F.coalesce(known, F.array().cast("array<string>"))) == 0) | F.exists(known, lambda x: travel_ok(a, x))
