"""Variant spellings of personal names: a symmetric-delete index on tokens, and tokens aligned by optimal assignment.

A name is cut into tokens with roles it may have: by-name (Abu X), the line of descent (given name, father, grandfather and so on, of any length), homes (al-X). Distinct tokens of
both sides are linked where their spellings, or their sounds in Latin letters, differ by at most one edit, or where one is an abbreviation or a nickname of the other; for that each token
is indexed under itself and under every spelling with one letter left out. Pairs of linked tokens are the blocks in which a spelling meets the names on record, so that no block
hangs on a frequent given name alone. Each meeting is scored by the cheapest assignment of the spelling's tokens to the roles of the name, line of descent in order,
initials, abbreviations and nicknames permitted; a spelling is linked if one person fits best.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khayt.runtime import stored

# Words that join a name to its father's, by script and sex; and words before a by-name.
JOINTS = frozenset("بن ابن بنت ابنه بنة ب bin ibn ben ebn bint bt binti b".split())
BYNAME = {"ابو": "m", "ابي": "m", "ابا": "m", "ام": "f", "abu": "m", "aboo": "m", "abou": "m", "abi": "m", "aba": "m", "umm": "f", "um": "f", "oumm": "f", "omm": "f"}
# Titles.
TITLES = frozenset(
    """الحافظ الامام الشيخ القاضي العلامه السيد السيده الفقيه المحدث الحاج المفتي الاستاذ الدكتور مولانا شيخ امام حافظ قاضي سيد سيدنا الصحابي التابعي
 hafiz imam shaykh sheikh shaikh qadi kadi qazi sayyid sayyida faqih hajj haji hajji mufti allama mawlana maulana hafez ustadh dr mr sheik cheikh""".split()
)
# Words that mean a relation or nobody in particular.
NOBODY = frozenset(
    """رجل رجلا امراه جده جدها ابيه ابيها ابوه عمه عمته خاله خالته امه اخيه اخته زوجها زوجته بعض اصحابنا من سمعه حدثه شيخ له مولي مولاه غيره
 man woman elder father mother grandfather grandmother uncle aunt brother sister companions companion one of our his her an a some who heard him someone""".split()
)
#: Wishes that follow a name.
WISHES = re.compile(
    r"(?:رحمه|رحمها|رضي|صلي|غفر|حفظه|ايده) (?:الله|لله)(?: (?:تعالي|عنه|عنها|عنهما|عنهم|عليه|وسلم|له|لها))*|عليه السلام|عليها السلام|\b(?:may (?:god|allah) .*|rahimahu ?llah|radiy?a ?'?llahu? ?'?anhu?|peace be upon h\w+|\(?(?:ra|rh|as|pbuh|d\. ?[0-9]+(?: ?ah)?)\)|"
    r"ﷺ|ﷻ)"
)
ARTICLE = re.compile(r"^(?:al|el|ul|as|ad|at|ar|az|an|ash|adh|ath)[-‐‑– ]+(?=['\w])|^ال(?=\w{2})")
_FOLD = str.maketrans({"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ة": "ه", "ى": "ي", "ؤ": "و", "ئ": "ي", "ء": None, "ـ": None, "پ": "ب", "چ": "ج", "ژ": "ز", "گ": "ك"})
# Nicknames and the names they stand for.
NICKNAMES = {
    "حموده": ("محمد", "احمد"), "حماده": ("محمد", "احمد"), "عبود": ("عبدالله",), "عبدو": ("عبدالله", "عبدالرحمن"), "فطوم": ("فاطمه",), "زنوبه": ("زينب",), "خدوج": ("خديجه",), "علاوي": ("علي",),
    "بهيم": ("ابراهيم",), "سلومه": ("سليمان",), "عيوش": ("عايشه",),
    "hamuda": ("muhammad", "ahmad"), "hamada": ("muhammad", "ahmad"), "mo": ("muhammad",), "abbud": ("abdallah",), "abdu": ("abdallah", "abdrahman"), "fattum": ("fatima",), "zannuba": ("zaynab",),
    "khadduj": ("khadija",), "allawi": ("ali",), "brahim": ("ibrahim",), "sliman": ("sulayman",), "ayyush": ("aisha",),
}


def plain(name: str) -> str:
    """Lower case, marks off, letters folded; a name in one script's bare letters."""
    text = unicodedata.normalize("NFD", name.lower())
    text = unicodedata.normalize("NFC", "".join(c for c in text if not unicodedata.combining(c) or c in "ٕٔ"))
    text = text.translate(_FOLD)
    text = re.sub(r"[’‘ʿʾʼ`´]", "'", text)
    return re.sub(r"\s+", " ", text).strip()


# Ways to write a sound, in the order in which they are replaced; ch is written for two of them.
SOUNDS = (
    ("dj", "j"), ("tch", "x"), ("ch", "x"), ("sh", "x"), ("kh", "x"), ("gh", "g"), ("dh", "d"), ("th", "t"), ("ph", "f"), ("q", "k"), ("v", "w"), ("oo", "u"), ("ou", "u"), ("ee", "i"),
    ("ei", "ay"), ("ai", "ay"), ("ae", "ay"), ("au", "aw"),
)


@lru_cache(1 << 16)
def sound(token: str) -> str:
    """One spelling for the ways a Latin token is written by ear; Arabic tokens as they are."""
    if not token.isascii():
        return token
    t = re.sub(r"[^a-z]", "", token)
    for a, b in SOUNDS:
        t = t.replace(a, b)
    t = t.replace("o", "u").replace("e", "i")
    t = re.sub(r"(.)\1+", r"\1", t.replace("z", "s"))
    return re.sub(r"(?<=[^aiuwyh])h", "", t)


@lru_cache(1 << 16)
def parse(name: str) -> tuple[tuple[str, str], ...]:
    """(token, flags) in order; flags: ``k`` a by-name, ``a`` written with the article, ``i`` an initial, ``j`` follows a joint."""
    text = WISHES.sub(" ", plain(name))
    text = re.sub(r"\b(abd)[ -]*(?:al|el|ul|ur|ar)?[ -]+(?=\w)|\b(abd)(?:ul|al|el|ur)[ -]+(?=\w)", "abd", text)
    text = re.sub(r"(?<!\w)عبد ال(?=\w)", "عبدال", text)
    text = re.sub(r"\b(?:(al|el) )(?=\w)", r"\1-", text)
    out: list[tuple[str, str]] = []
    words = re.findall(r"[\w'‐‑–-]+\.?|,|،", text)
    joint = kunya = False
    for i, w in enumerate(words):
        if w in ",،":
            joint = False
            continue
        bare = w.rstrip(".")
        following = words[i + 1].rstrip(".") if i + 1 < len(words) else ""
        initial = w.endswith(".") and len(bare) <= 3 and (len(bare) == 1 or bare not in JOINTS)
        if bare in JOINTS and not (initial and (not out or following in JOINTS) and (not joint or following in JOINTS)) and (out or not initial):
            joint = True
            continue
        if bare in BYNAME and following and following not in JOINTS:
            kunya = True
            continue
        m = ARTICLE.match(bare)
        core = (bare[m.end() :] if m else bare).strip("'-‐‑–")
        core = core.replace("'", "") if core.isascii() else core
        if not core or (not kunya and not joint and (core in TITLES or bare in TITLES)):
            continue
        out.append((core, ("k" if kunya else "") + ("a" if m else "") + ("i" if initial else "") + ("j" if joint else "")))
        joint = kunya = False
    return tuple(out)


def is_nobody(tokens: tuple[tuple[str, str], ...]) -> bool:
    """A bare name, or words that name a relation."""
    return len(tokens) < 2 or all(t in NOBODY for t, _ in tokens)


def distance(a: str, b: str, most: int = 1) -> int:
    """Edits between two tokens (a letter more, less or other, or two neighbours swapped), or most + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    if most == 1:
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        if len(a) == len(b):
            return 1 if a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]) else 2
        return 1 if (a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]) else 2
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[-1] = min(row[-1], rows[-2][j - 2] + 1)
        rows.append(row)
    return min(rows[-1][-1], most + 1)


#: Costs of an assignment; a token with an edit costs one.
RESPELT, EDIT, INITIAL, SHORTENED, NO_ROLE = 0.25, 1.0, 0.5, 1.0, 9.0
MOST = 2.1


def is_abbreviation(a: str, b: str) -> bool:
    """Whether Latin token a shortens b: its beginning, or letters of it in order with the first two and the last (dropped vowels, Muhd); at least three letters, two fewer than b."""
    a, b = (x if x.isascii() else "" for x in (a, b))
    if not 3 <= len(a) <= len(b) - 2:
        return False
    if b.startswith(a) or sound(b).startswith(sound(a)):
        return True
    rest = iter(b)
    return a[:2] == b[:2] and a[-1] == b[-1] and all(c in rest for c in a)


@lru_cache(1 << 18)
def token_cost(a: str, b: str) -> float:
    """0 the same, RESPELT the same sound, EDIT one edit apart, in spelling or sound; NO_ROLE otherwise."""
    if a == b:
        return 0.0
    sa, sb = sound(a), sound(b)
    if sa == sb:
        return RESPELT
    if min(len(a), len(b)) >= 2 and max(len(a), len(b)) >= 3 and distance(a, b) == 1:
        return EDIT
    if a.isascii() and len(sa) >= 3 and len(sb) >= 3 and distance(sa, sb) == 1:
        return EDIT + RESPELT
    if b in _nicknames().get(sa, ()) or is_abbreviation(a, b):
        return SHORTENED
    return NO_ROLE


@cache
def _nicknames() -> dict[str, frozenset[str]]:
    """By sound, the names a nickname stands for, in all spellings of the same sound that the table has."""
    out: dict[str, frozenset[str]] = {}
    for nick, names in NICKNAMES.items():
        out[sound(nick)] = out.get(sound(nick), frozenset()) | frozenset(names)
    return out


#: What is told of a person in one script: by-name, line of descent (given name first), homes.
TOLD = "k string, line array<string>, homes array<string>"


def roles_of(tokens: tuple[tuple[str, str], ...]) -> tuple[str | None, list[str], list[str]]:
    """(by-name, line, homes) of a name on record: by-names are marked, the line follows joints, tokens with the article or without a joint after the given name are homes."""
    byname, line, homes = None, [], []
    for t, flags in tokens:
        if "k" in flags:
            byname = t
        elif "j" in flags or not (line or ("a" in flags and byname)):
            line.append(t)
        elif t not in homes:
            homes.append(t)
    return byname, line, homes


def initial_cost(text: str, name: str) -> float:
    """Of a token with a dot: one that the name begins with, or that shortens it."""
    if name.startswith(text) or sound(name).startswith(sound(text)):
        return INITIAL
    return SHORTENED if is_abbreviation(text, name) else NO_ROLE


def assign(tokens: tuple[tuple[str, str], ...], byname: str | None, line: Sequence[str], homes: Sequence[str], known: frozenset[str] = frozenset()) -> tuple[float, str]:
    """(cost, roles filled) of the cheapest assignment of all tokens to different roles, those of the line of descent in order; cost NO_ROLE or more if there is none.

    Roles filled: k by-name, g given name, f father, p one further up, n home. known: tokens that are names of their own; such a token is never taken for an edit or
    abbreviation of another. One token after another is placed; of equal states (place in the line, by-name and homes used) only the cheapest is kept.
    """
    states: dict[tuple[int, frozenset[int], str], float] = {(0, frozenset(), ""): 0.0}
    for text, flags in tokens:
        following: dict[tuple[int, frozenset[int], str], float] = {}

        def cost_of(name: str, text: str = text, flags: str = flags) -> float:
            if "i" in flags:
                return initial_cost(text, name)
            c = token_cost(text, name)
            return NO_ROLE if c >= EDIT and text in known else c

        def put(state: tuple, cost: float, following: dict = following) -> None:
            if cost <= MOST and cost < following.get(state, NO_ROLE):
                following[state] = cost

        as_byname = cost_of(byname) if "k" in flags and byname else NO_ROLE
        in_line = {at: c for at, name in enumerate(line) if (c := cost_of(name)) < NO_ROLE} if "k" not in flags and ("a" not in flags or "j" in flags) else {}
        as_home = {at: c for at, name in enumerate(homes) if (c := cost_of(name)) < NO_ROLE} if "k" not in flags and "j" not in flags and "i" not in flags else {}
        for (next_, used, filled), cost in states.items():
            if as_byname < NO_ROLE and "k" not in filled:
                put((next_, used, "".join(sorted({*filled, "k"}))), cost + as_byname)
            for at, c in in_line.items():
                if at >= next_:
                    put((at + 1, used, "".join(sorted({*filled, "gfp"[min(at, 2)]}))), cost + c)
            for at, c in as_home.items():
                if at not in used:
                    put((next_, used | {at}, "".join(sorted({*filled, "n"}))), cost + c)
        states = following
        if not states:
            return NO_ROLE, ""
    cost, filled = min((cost, filled) for (_, _, filled), cost in states.items())
    return cost, filled


def enough(filled: str, tokens: tuple[tuple[str, str], ...]) -> bool:
    """Whether the roles filled tell a person: given name and father, of which initials prove nothing, or a by-name or grandfather with what makes it more than a bare name."""
    got = set(filled)
    strong = len(tokens) - sum("i" in f for _, f in tokens)
    return {"g", "f"} <= got and strong >= 2 or {"k", "n"} <= got or {"k", "g"} <= got or {"g", "p", "n"} <= got and strong >= 2


def keys_of(token: str, on_record: bool) -> set[str]:
    """The spellings under which a token is indexed: itself and with one letter left out, and its sound in the same way; and under what shortens it.

    A name on record is indexed under its beginnings and under its first two letters with its last; a token of a spelling under itself in these ways, and under the names it is a nickname of.
    """
    s = sound(token)
    out = {f"w{token}", f"s{s}"} | {f"w{token[:i]}{token[i + 1 :]}" for i in range(len(token))} | {f"s{s[:i]}{s[i + 1 :]}" for i in range(len(s))}
    if not token.isascii():
        return out if on_record else out | {f"w{name}" for name in _nicknames().get(s, ())}
    if on_record:
        out |= {f"p{x[:i]}" for x in (token, s) for i in range(2, len(x))}
    else:
        out |= {f"w{name}" for name in _nicknames().get(s, ())} | ({f"p{token}", f"p{s}"} if len(token) >= 3 else set())
    return out | ({f"c{token[:2]}{token[-1]}"} if len(token) >= (5 if on_record else 3) else set())


def _script(text: str) -> str:
    return "ar" if re.search(r"[\u0600-\u06ff]", text) else "en"


def _parsed(names: DataFrame, as_roles: bool) -> DataFrame:
    """(id, script, tokens or what is told) of (id, name) with plain names; what is no name has no row."""
    kind, fields = (TOLD, ("k", "line", "homes")) if as_roles else ("tokens array<struct<t:string,f:string>>", ("tokens",))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, name in zip(frame["id"], frame["name"], strict=True):
                tokens = parse(name)
                if as_roles:
                    byname, line, homes = roles_of(tokens)
                    if (byname is not None) + len(line) + len(homes) > 1:
                        rows.append((key, _script(name), byname, line, homes))
                elif not is_nobody(tokens):
                    rows.append((key, _script(name), [{"t": t, "f": f} for t, f in tokens]))
            yield pd.DataFrame(rows, columns=["id", "script", *fields])

    return names.select("id", "name").mapInPandas(work, f"id string, script string, {kind}")


def _links(spelt: DataFrame, known: DataFrame) -> DataFrame:
    """(script, t, v, cost): tokens of spellings with the tokens on record they may stand for, by the symmetric-delete index."""

    def spread(on_record: bool):
        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = [(s, t, k) for s, t in zip(frame["script"], frame["t"], strict=True) for k in keys_of(t, on_record)]
                yield pd.DataFrame(rows, columns=["script", "t", "key"])

        return work

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(cost=[token_cost(t, v) for t, v in zip(frame["t"], frame["v"], strict=True)])
            yield frame[(frame["cost"] < EDIT) | ((frame["cost"] < NO_ROLE) & ~frame["own"])][["script", "t", "v", "cost"]]

    kind = "script string, t string, key string"
    left = spelt.select("script", "t", "own").distinct()
    index = known.select("script", F.col("v").alias("t")).distinct().mapInPandas(spread(True), kind).withColumnRenamed("t", "v")
    met = left.select("script", "t").mapInPandas(spread(False), kind).join(index, ["script", "key"]).select("script", "t", "v").distinct()
    return met.join(left, ["script", "t"]).select("script", "t", "v", "own").mapInPandas(verify, "script string, t string, v string, cost double")


def profiles(persons: DataFrame) -> DataFrame:
    """(person, script, k, line, homes): what each person's names on record say in each script; what one name leaves out (by-name, homes, ancestors beyond its last) is taken from the
    person's other names.

    persons: (person, name), plain names, repeats allowed.
    """
    said = stored(_parsed(persons.select(F.col("person").alias("id"), "name").dropna().distinct(), True).withColumnRenamed("id", "person").distinct(), "names")
    by = ["person", "script"]
    bynames = said.where("k is not null").select(*by, F.col("k").alias("k2")).distinct()
    homes = said.where("size(homes) > 0").select(*by, F.col("homes").alias("homes2")).distinct()
    first = [F.get("line", F.lit(i)).alias(n) for i, n in enumerate(("_g", "_f"))]
    lines = said.where("size(line) > 2").select(*by, *first, F.col("line").alias("line2")).distinct()
    out = said.select("*", *first).join(bynames, by, "left").join(homes, by, "left").alias("a")
    longer = F.expr("size(line2) > size(line) and slice(line2, 1, size(line)) = line")
    out = out.join(lines.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*by, "_g", "_f")] + [longer], "left")
    no_homes = F.size("homes") == 0
    return out.select(
        "a.person", "a.script", F.coalesce("k", "k2").alias("k"), F.coalesce("line2", "line").alias("line"), F.when(no_homes, F.coalesce("homes2", "homes")).otherwise(F.col("homes")).alias("homes")
    ).distinct()


#: A name on record with more tokens than this is found by its single tokens, not by their pairs, whose number grows with the square.
PAIRED = 12
#: Tokens of a spelling are paired with so many that follow.
AHEAD = 4


def _blocks(known: DataFrame) -> DataFrame:
    """(script, x, y, pid): the pairs x <= y of tokens of each name on record; of names of more than PAIRED tokens the single tokens, with an empty y."""
    tokens = known.select("pid", "script", F.array_distinct(F.array_compact(F.concat(F.array("k"), "line", "homes"))).alias("t"))
    some = F.size("t") <= PAIRED
    pairs = F.flatten(F.transform("t", lambda x, i: F.transform(F.expr("t"), lambda y, j: F.when(j > i, F.struct(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))))))
    pairs = F.filter(pairs, lambda p: p.isNotNull())
    # A token that a name has twice (a man named after his grandfather) pairs with itself.
    twice = F.expr("transform(filter(t, v -> size(filter(whole, w -> w = v)) > 1), v -> struct(v as x, v as y))")
    whole = known.select("pid", F.array_compact(F.concat(F.array("k"), "line", "homes")).alias("whole"))
    short = tokens.where(some).join(whole, "pid").select("pid", "script", F.inline(F.concat(pairs, twice)))
    long = tokens.where(~some).select("pid", "script", F.explode("t").alias("x"), F.lit("").alias("y"))
    return short.unionByName(long).distinct()


def same_person(spellings: DataFrame, persons: DataFrame) -> DataFrame:
    """(id, person) for each spelling (id, name) that means one person among persons (person, name); names come in plain form.

    Null, empty and bare names, words of kinship and spellings that fit two persons equally well mean nobody. Names have any number of tokens. Repeated rows count once. Persons without a
    name are never meant; no persons or no spellings give no rows. Ids are text. Tokens of a spelling must all find their role, so each pair of them is necessary: a spelling is
    compared with the names in the smallest of its pairs' blocks only (tokens paired with the AHEAD following), which loses nothing.
    """
    names = spellings.select("id", "name").dropna().distinct()
    forms = stored(_parsed(names.select(F.col("name").alias("id"), "name").distinct(), False), "spellings").withColumnRenamed("id", "name")
    known = stored(profiles(persons).withColumn("pid", F.xxhash64("person", "script", "k", "line", "homes")), "profiles")
    roles = known.select("script", F.col("k").alias("v"), F.lit(False).alias("own")).where("v is not null").unionByName(
        known.select("script", F.explode("line").alias("v"), F.lit(True).alias("own"))).unionByName(known.select("script", F.explode("homes").alias("v"), F.lit(False).alias("own")))
    own = roles.where("own").select("script", F.col("v").alias("t")).distinct().withColumn("own", F.lit(True))
    cells = forms.select("name", "script", F.posexplode("tokens").alias("pos", "x")).select("name", "script", "pos", F.col("x.t").alias("t"), F.col("x.f").alias("f"))
    cells = stored(cells.join(own, ["script", "t"], "left").withColumn("own", F.coalesce("own", F.lit(False))), "tokens")
    spelt = cells.where(~F.col("f").contains("i"))
    links = _links(spelt, roles)
    # A pair of tokens of a spelling meets the pairs of tokens of the names on record; single tokens meet those of the very long ones.
    may = stored(spelt.join(links, ["script", "t"]).select("name", "script", "pos", "v"), "may")
    part = lambda pos: F.floor(pos / AHEAD)  # noqa: E731  a token and the AHEAD that follow lie in one part or two
    a = may.select("name", "script", F.col("pos").alias("i"), F.col("v").alias("x"), F.explode(F.array(part(F.col("pos")), part(F.col("pos")) + 1)).alias("_part"))
    b = may.select("name", F.col("pos").alias("j"), F.col("v").alias("y"), part(F.col("pos")).alias("_part"))
    asked = a.join(b, ["name", "_part"]).where(F.expr(f"i < j and j <= i + {AHEAD}")).select("name", "script", "i", "j", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    asked = asked.unionByName(may.select("name", "script", F.col("pos").alias("i"), F.lit(-1).alias("j"), F.col("v").alias("x"), F.lit("").alias("y")))
    blocks = stored(_blocks(known), "blocks")
    sizes = blocks.groupBy("script", "x", "y").agg(F.count(F.lit(1)).alias("size"))
    asked = stored(asked.join(sizes, ["script", "x", "y"]), "pairs")
    single = (F.col("j") < 0).alias("single")
    best = asked.groupBy("name", "i", "j").agg(F.sum("size").alias("size")).groupBy("name", single).agg(F.min(F.struct("size", "i", "j")).alias("best"))
    chosen = asked.withColumn("single", single).join(best, ["name", "single"]).where((F.col("i") == F.col("best.i")) & (F.col("j") == F.col("best.j"))).select("name", "script", "x", "y")
    met = chosen.join(blocks, ["script", "x", "y"]).select("name", "pid").distinct()
    flagged = cells.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("pos", "t", "f", "own"))).alias("tokens"))
    rows = met.join(flagged, "name").join(known.select("pid", "person", "k", "line", "homes"), "pid")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, person, tokens, byname, line, homes in zip(*(frame[c] for c in ("name", "person", "tokens", "k", "line", "homes")), strict=True):
                given = tuple((x["t"], x["f"]) for x in tokens)
                cost, filled = assign(given, byname if isinstance(byname, str) else None, list(line), list(homes), frozenset(x["t"] for x in tokens if x["own"]))
                if cost < NO_ROLE and enough(filled, given):
                    out.append((name, person, cost))
            yield pd.DataFrame(out, columns=["name", "person", "cost"])

    scored = stored(rows.select("name", "person", "tokens", "k", "line", "homes").mapInPandas(score, "name string, person string, cost double"), "scored")
    least = scored.groupBy("name").agg(F.min("cost").alias("cost"))
    one = scored.join(least, ["name", "cost"]).groupBy("name").agg(F.min("person").alias("person"), F.max("person").alias("_last")).where(F.col("person") == F.col("_last"))
    return names.join(one.select("name", "person"), "name").groupBy("id").agg(F.min("person").alias("person"), F.max("person").alias("_last")).where(F.col("person") == F.col("_last")).select("id", "person")
