"""Arabic-aware text functions as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vowel and reading marks; marks that steer direction or join letters; letters that are folded, with what they become.
DIACRITICS = "\\u064B-\\u065F\\u0670"
FORMAT_MARKS = "\\u200B-\\u200F\\u202A-\\u202E\\u2066-\\u2069\\uFEFF\\u06DD"
URDU_FROM, URDU_TO = "کڪیےۓہۂۀھں", "ككيييههههن"
ALIF_FROM, ALIF_TO = "أإآٱ", "اااا"
HAMZA_FROM, HAMZA_TO = "ؤئ", "ءء"
TATWEEL = "ـ"
# Words and phrases of transmission.
TRANSMISSION = {
    "حدثنا": "haddathana", "حدثني": "haddathani", "أخبرنا": "akhbarana", "أخبرني": "akhbarani", "أنبأنا": "anba_ana", "أنبأني": "anba_ani",
    "سمعت": "samitu", "سمع": "samia", "عن": "an", "قال": "qala", "ناولني": "nawalani", "كتب إلي": "kataba_ilayya",
}
#: Terms that only count as whole words.
SHORT_TERMS = ("عن", "قال", "سمع")
LETTER = "\\u0621-\\u063A\\u0640-\\u065F\\u0670-\\u06D3"
# Inflected forms of names that stand for one, and names whose accusative is folded.
KUNYA_FORMS, KUNYA = ("ابا", "ابي"), "ابو"
ACCUSATIVE = tuple("علي انس جابر مالك نافع سعد بلال سالم مكحول ثابت معاذ جندب مطرف خباب زيد محمد حميد سعيد عمار صهيب معمر عامر سهل كعب تميم".split())


def strip_diacritics(c: Column) -> Column:
    return F.regexp_replace(c, f"[{DIACRITICS}]", "")


def strip_format_marks(c: Column) -> Column:
    return F.regexp_replace(c, f"[{FORMAT_MARKS}]", "")


def clean_whitespace(c: Column) -> Column:
    """Runs of Unicode white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_urdu(c: Column) -> Column:
    return F.translate(c, URDU_FROM, URDU_TO)


def normalize_letters(c: Column) -> Column:
    """Alif forms to alif, hamza carriers to hamza, ta marbuta to ha, alif maqsura to ya; no tatweel."""
    return F.translate(c, f"{ALIF_FROM}{HAMZA_FROM}ةى{TATWEEL}", f"{ALIF_TO}{HAMZA_TO}هي")


def normalize_arabic(c: Column) -> Column:
    """Format marks and diacritics off, letters folded, white space collapsed. Null stays null; applied twice it changes nothing."""
    return clean_whitespace(normalize_letters(normalize_urdu(F.regexp_replace(c, f"[{FORMAT_MARKS}{DIACRITICS}]", ""))))


def strip_to_letters(c: Column) -> Column:
    """Letters and single blanks only."""
    return F.trim(F.regexp_replace(c, r"[^\p{L}]+", " "))


def is_arabic(c: Column) -> Column:
    return c.rlike("[\\u0600-\\u06FF]")


def arabic_span(c: Column) -> Column:
    """The Arabic of a mixed text; the text itself where there is none."""
    span = clean_whitespace(F.regexp_replace(c, "[^\\u0600-\\u06FF\\u0750-\\u077F\\u08A0-\\u08FF\\uFB50-\\uFDFF\\uFE70-\\uFEFF\\s]+", " "))
    return F.when(span != "", span).otherwise(F.trim(c))


def has_transmission_term(c: Column) -> Column:
    """Whether a term of transmission stands as a word of its own, whatever its marks."""
    terms = "|".join(t.translate(str.maketrans("أإ", "اا")) for t in TRANSMISSION)
    return normalize_arabic(c).rlike(f"(?<![{LETTER}])(?:{terms})(?![{LETTER}])")


def canonical_surface(c: Column) -> Column:
    """The spelling that identifies a name: normalised, without lone hamza, by-name cases to one, joined servant names cut, accusatives folded."""
    tokens = F.split(F.translate(normalize_arabic(c), "ىء", "ي"), " ")

    def fold(t: Column) -> Column:
        return (
            F.when(t.isin(*KUNYA_FORMS), F.lit(KUNYA))
            .when(t.startswith("عبدال") & (F.length(t) > 5), F.concat(F.lit("عبد "), F.substring(t, 4, 1000)))
            .when(t.endswith("ا") & F.substring(t, F.lit(1), F.length(t) - 1).isin(*ACCUSATIVE), F.substring(t, F.lit(1), F.length(t) - 1))
            .otherwise(t)
        )

    return F.array_join(F.filter(F.transform(tokens, fold), lambda t: t != ""), " ")


# Latin letters for Arabic ones.
LATIN_LETTERS = {
    "ا": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r", "ز": "z", "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l", "م": "m", "ن": "n", "ه": "h", "ة": "a", "و": "w", "ي": "y", "ى": "a", "ء": "",
}
# Common parts of names and their Latin forms.
LATIN_NAMES = {
    "أبو": "Abu", "أبا": "Aba", "أبي": "Abi", "ابن": "ibn", "بن": "ibn", "بنت": "bint", "أم": "Umm", "عبد": "Abd", "الله": "Allah", "عبدالله": "Abd Allah", "عبدالرحمن": "Abd al-Rahman", "الرحمن": "al-Rahman",
    "الرحيم": "al-Rahim", "الصديق": "al-Siddiq", "الفاروق": "al-Faruq", "محمد": "Muhammad", "أحمد": "Ahmad", "علي": "Ali", "حسن": "Hasan", "الحسن": "al-Hasan", "حسين": "Husayn", "الحسين": "al-Husayn",
    "عمر": "Umar", "عثمان": "Uthman", "إبراهيم": "Ibrahim", "إسماعيل": "Ismail", "إسحاق": "Ishaq", "يعقوب": "Yaqub", "يوسف": "Yusuf", "موسى": "Musa", "عيسى": "Isa", "داود": "Dawud", "سليمان": "Sulayman",
    "يحيى": "Yahya", "خالد": "Khalid", "جعفر": "Jafar", "صالح": "Salih", "حماد": "Hammad", "حمزة": "Hamza", "زيد": "Zayd", "سعيد": "Said", "سعد": "Sad", "سفيان": "Sufyan", "سلمان": "Salman", "طلحة": "Talha",
    "عمرو": "Amr", "عباس": "Abbas", "العباس": "al-Abbas", "معاوية": "Muawiya", "مالك": "Malik", "أنس": "Anas", "بكر": "Bakr", "هريرة": "Hurayra", "الزبير": "al-Zubayr", "عوف": "Awf", "الخطاب": "al-Khattab",
    "شعبة": "Shuba", "قتادة": "Qatada", "نافع": "Nafi", "مجاهد": "Mujahid", "عطاء": "Ata", "هشام": "Hisham", "عروة": "Urwa", "معمر": "Mamar", "وكيع": "Waki", "الوليد": "al-Walid", "يزيد": "Yazid", "جابر": "Jabir",
    "ثابت": "Thabit", "حذيفة": "Hudhayfa", "عمار": "Ammar", "بلال": "Bilal", "عائشة": "Aisha", "فاطمة": "Fatima", "خديجة": "Khadija", "سلمى": "Salma", "البخاري": "al-Bukhari", "المدني": "al-Madani",
    "الكوفي": "al-Kufi", "البصري": "al-Basri", "الدمشقي": "al-Dimashqi", "الأنصاري": "al-Ansari", "القرشي": "al-Qurashi", "التميمي": "al-Tamimi", "الثقفي": "al-Thaqafi", "الهمداني": "al-Hamdani",
    "الزهري": "al-Zuhri", "الثوري": "al-Thawri", "الأعمش": "al-Amash", "الشعبي": "al-Shabi", "الأوزاعي": "al-Awzai", "الليث": "al-Layth", "الأشعري": "al-Ashari", "السلمي": "al-Sulami",
}
_PLAIN = str.maketrans("أإآٱةىؤئ", "ااااهيءء")


def transliterate(c: Column) -> Column:
    """A readable Latin form of an Arabic name; empty for null and blank names."""
    names = F.create_map(*[F.lit(x) for k, v in LATIN_NAMES.items() for x in (k.translate(_PLAIN), v)])
    letters = F.create_map(*[F.lit(x) for k, v in LATIN_LETTERS.items() for x in (k, v)])

    def spell(t: Column) -> Column:
        return F.array_join(F.transform(F.split(t, ""), lambda x: F.coalesce(letters[x], F.lit(""))), "")

    def capital(t: Column) -> Column:
        return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1000))

    def token(raw: Column) -> Column:
        norm = normalize_arabic(raw)
        latin = (
            F.when(names[norm].isNotNull(), names[norm]).when(~is_arabic(norm), F.trim(raw))
            .when(norm.startswith("ال") & (F.length(norm) > 2), F.concat(F.lit("al-"), capital(spell(F.substring(norm, 3, 1000))))).otherwise(capital(spell(norm)))
        )
        return F.when(norm == "", F.lit("")).otherwise(latin)

    tokens = F.split(clean_whitespace(F.translate(F.coalesce(c, F.lit("")), TATWEEL, "")), " ")
    bare = F.transform(tokens, lambda t: F.regexp_replace(t, r"""^[،.,;:()\[\]{}"'`-]+|[،.,;:()\[\]{}"'`-]+$""", ""))
    latin = F.filter(F.transform(bare, token), lambda t: t != "")
    return F.array_join(F.transform(latin, lambda t, i: F.when((i == 0) & t.isin("ibn", "bint"), F.initcap(t)).otherwise(t)), " ")


# The same expressions in DuckDB's SQL, for the comparison queries.
def sql_normalize(x: str) -> str:
    marks = "[\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2066}-\\x{2069}\\x{FEFF}\\x{06DD}\\x{064B}-\\x{065F}\\x{0670}]"
    folded = f"translate(regexp_replace({x}, '{marks}', '', 'g'), '{URDU_FROM}', '{URDU_TO}')"
    folded = f"translate({folded}, '{ALIF_FROM}{HAMZA_FROM}ةى{TATWEEL}', '{ALIF_TO}{HAMZA_TO}هي')"
    return f"trim(regexp_replace({folded}, '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]+', ' ', 'g'))"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
