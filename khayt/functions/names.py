"""Rule-based cleaning of narrator names: what is no part of a name is cut off, what is no name becomes null."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from khayt.functions.segment import normal

# The word lists of the rules, in normalised spelling.
WISHES = ("صلي الله عليه واله وسلم", "صلي الله عليه وسلم", "صلي الله عليه واله", "صلي الله عليه", "رضي الله عنهما", "رضي الله عنهم", "رضي الله عنها", "رضي الله عنه", "رضي الله", "عليهم السلام", "عليها السلام", "عليه السلام", "رحمه الله", "عز وجل", "تبارك وتعالي", "الشيخ الجليل", "ﷺ")
CONNECTIVES = frozenset(["يعني"])
FORMULAS = frozenset("باسناده بالاسناد اسناده عنه روي قد به فيه منه نحوه مثله".split())
NOBODIES = frozenset("رجل رجلا رجال ناس اناس اناسا ناسا جماعه جمله قوم نفر عده بعض شيخ غير".split())
RELATIONS = frozenset("ابيه ابي ابيها امه امها ابنه ابنها ابنته ابنتها جده جدها جدته جدتها اخيه اخيها اخته اختها عمه عمها عمته عمتها خاله خالها خالته خالتها زوجته زوجها عنه امي ابني ابنتي بنتي جدي جدتي اخي اختي عمي عمتي خالي خالتي امتاه ابتاه".split())
PROPHET, PROPHET_LEADS = frozenset("النبي الرسول للنبي للرسول".split()), frozenset("رسول نبي لرسول لنبي".split())
APPOSITION = frozenset("زوج زوجه بنت ابنه ابنته ام اخت اهل مولي مولاه خادم خادمه صاحب صاحبه عم خال جد عمه".split())
ENGLISH_PROSE = frozenset("it its this these those that there the he she they we you him his her my our your their was were is are has have had been be will would did narrated said says reported related told mentioned transmitted then when while from to by of for with and but as at upon about which who whom whose what".split())
BOUNDARIES = frozenset("كان كانت قال قالت قالوا فقال فقالت يقول تقول قلت قلنا حدثنا حدثني اخبرنا اخبرني انبانا سمعت حدثاه جاء قام سال فساله سءل سالت اساله حدث حدثت روت قالا قالتا وقال وقالت وقالوا فقالوا سمع كتب انه انها انهم انهما عن ان الذي التي الذين اذ اذا حين حينما لما فلما ثم حتي والله هو وهو قيل يقال".split())
DENSE = frozenset("كان كانت قال قالت قالوا فقال يقول اذ حين لما فلما ثم حتي والله هو وهو حدث حدثت روت قالا قالتا".split())
OPENERS = frozenset("قلت قلنا كنا كنت نهي امر صلي صلت رايت بينما بينا نعم بلي سالت سءل روي كتبت يا تزوج رءيا انشدك نشدتك".split())
PARTICLES = frozenset("في الي عند بعد قبل مع لدي بين نحو نحن انا انت انتم هم هما اليك اليه اليها اليهم لك له لها لهم لنا هذا هذه هءلاء ذلك تلك هناك هنا حيث لو لولا ما لا لم لن او ام الا لكن بل قد كل بعض اما انما كي كيف متي اين لذلك لذا كذلك كذا".split())
COLLECTIVES = frozenset("اصحاب ازواج نساء اهل ال امه".split())
NASAB = frozenset("بن ابن بنت ابو ابي ابا بني بنو".split())
GRADINGS = (("هذا", "حديث"), ("حديث", "حسن"), ("حديث", "صحيح"), ("حديث", "غريب"), ("حديث", "ضعيف"), ("حسن", "صحيح"), ("حسن", "غريب"), ("صحيح", "غريب"), ("متفق", "عليه"), ("هذا", "الحديث"), ("غير", "واحد"))
MOST_TOKENS = 30
_EDGE = " \t\r\n,،.;؛:؟-_\"'«»()[]"
_BENEDICTION = re.compile(r"[(\[]\s*(?:s\.?a\.?w\.?w?|p\.?b\.?u\.?h|r\.?a\.?a?|r\.?a\.?h|a\.?s|s\.?w\.?t|r\.?t\.?a)\s*\.?\s*[)\]]", re.I)
_TITLE = re.compile(r"^\s*(?:prophet|hazrat|hadhrat|sayyidina|sayyiduna|sayyidna|imam)\s+", re.I)


def _residue(t: str) -> bool:
    t2 = t[1:] if t.startswith("و") and len(t) > 1 else t
    return t in FORMULAS or t2 in FORMULAS or t in NOBODIES


def _particle(t: str) -> bool:
    return t in PARTICLES or (t[:1] in ("و", "ف") and t[1:] in PARTICLES)


def _partitive(t: str) -> bool:
    return t == "من" or (t[:1] in ("و", "ف", "ك", "ل", "ب") and t[1:] == "من")


def _boundary(t: str) -> bool:
    u = t
    while u[:1] in ("و", "ف", "ب", "ل", "ك") and len(u) > 1:
        u = u[1:]
        if u in ("الذي", "التي", "الذين"):
            return True
    return t in BOUNDARIES


def _prophet(t: list[str]) -> bool:
    return (len(t) == 1 and t[0] in PROPHET) or (len(t) > 1 and t[0] in PROPHET_LEADS and t[1] == "الله")


def is_sentence(tokens: list[str], text: str) -> bool:
    """Whether the words are a piece of text and no name."""
    if any(tuple(tokens[i : i + 2]) in GRADINGS for i in range(len(tokens) - 1)):
        return True
    if tokens[0] in OPENERS and len(tokens) > 1:
        return True
    loose = sum(_particle(t) for t in tokens)
    nasab = sum(t in NASAB for t in tokens)
    return len(tokens) >= 3 and (any(s in text for s in "«»؟") or (loose >= 2 and nasab / len(tokens) < 0.15))


def clean_name(name: str | None) -> str | None:
    """The name that a normalised span holds, or None."""
    if not name:
        return None
    text = _TITLE.sub("", _BENEDICTION.sub(" ", re.sub(r"<[^>]*>", " ", name)))
    for wish in WISHES:
        text = re.sub(rf"(?:^|(?<=\s)){re.escape(wish)}(?=\s|$)", " ", text)
    if ":" in text and len(text.split(":")[0].split()) >= 1:
        text = text.split(":")[0]
    tokens = [t for t in (w.strip(_EDGE) for w in text.split()) if t and normal(t) not in CONNECTIVES]
    while tokens and re.fullmatch(r"[0-9٠-٩]+", tokens[0]):
        tokens.pop(0)
    if not tokens:
        return None
    n = [normal(t) for t in tokens]
    cut = next((i for i, t in enumerate(n) if _boundary(t)), len(n))
    if not cut:
        return None
    n, tokens = n[:cut], tokens[:cut]
    for i, t in enumerate(n[:-1]):
        if i and t in APPOSITION and _prophet(n[i + 1 :]):
            n, tokens = n[:i], tokens[:i]
            break
    while n and (n[-1] in ("و", "جميعا", "من") or n[-1] in NASAB or n[-1] in OPENERS):
        n.pop()
        tokens.pop()
    if not n or len(n) > MOST_TOKENS:
        return None
    if n[0] in NOBODIES and (len(n) == 1 or _partitive(n[1])) or all(_residue(t) or _particle(t) or _partitive(t) or t in COLLECTIVES or len(t) == 1 for t in n):
        return None
    if (len(n) == 1 and n[0] in RELATIONS) or _prophet(n) or (n[0] in COLLECTIVES and _prophet(n[1:])):
        return None
    low = [t.lower() for t in tokens]
    if low[0] in ENGLISH_PROSE or sum(t in ENGLISH_PROSE for t in low) >= 2 or sum(t in DENSE for t in n) >= 2:
        return None
    if is_sentence(n, text):
        lead = next((i for i, t in enumerate(n) if _particle(t) or t in OPENERS), len(n))
        if lead < 2:
            return None
        n, tokens = n[:lead], tokens[:lead]
    if len("".join(n)) < 2:
        return None
    return " ".join(tokens)


def split_compound(name: str | None) -> list[str]:
    """Names joined by a lone "and", each for itself."""
    return [p for p in re.split(r"\s+و\s+", name or "") if p]


@F.pandas_udf(StringType())
def clean_name_udf(name: pd.Series) -> pd.Series:
    return pd.Series([clean_name(n) for n in name], dtype="object")
