import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from khayt.llm import bpe as B
from khayt.llm import names as N
from khayt.llm import packing as P

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def known():
    t = tokenizers.Tokenizer.from_file(B.TOKENIZER)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def own():
    return B.Encoder(B.read_vocabulary())


def ids(encoder, texts):
    flat, starts = encoder.encode(pa.array(texts, pa.large_string()))
    return [flat[a:b].tolist() for a, b in itertools.pairwise(starts)]


def test_equals_the_library(known, own):
    texts = ["", None, "Hello world", "قال رسول الله ﷺ", "<|endoftext|> a", "  two\n\n tabs\t", "it's we'LL 123 ½", "a" * 3001, "اب" * 700, "".join(random.Random(4).choices("abcdefghijklmnopqrstuvwxyzابتثج", k=4000)), "🙂👍🏽", "x\u0301 y\u200c", "\r\n\u3000\u00a0 z"]
    assert ids(own, texts) == [known.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(texts):
    known = tokenizers.Tokenizer.from_file(B.TOKENIZER)
    known.encode_special_tokens = True
    global _own
    _own = globals().get("_own") or B.Encoder(B.read_vocabulary())
    assert ids(_own, texts) == [known.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_changes_nothing(own, monkeypatch):
    texts = [f"word{i} كلمة{i}" for i in range(200)]
    want = ids(own, texts)
    monkeypatch.setattr(B, "WORDS_KEPT", 50)
    monkeypatch.setattr(B, "BYTES_AT_ONCE", 64)
    monkeypatch.setattr(B, "MOST_STEPS", 2)
    fresh = B.Encoder(B.read_vocabulary())
    assert [x for t in texts for x in ids(fresh, [t])] == want


def test_ranks_give_the_same_merges(known):
    e = B.Encoder(B.read_vocabulary(B.TOKENIZER.replace(".json", ".tiktoken")))
    texts = ["Hello world, this is a test", "حدثنا مالك عن نافع", "aaaa bbbb 1234"]
    assert ids(e, texts) == [known.encode(t, add_special_tokens=False).ids for t in texts]


def test_frames_and_round_trip(spark):
    d = spark.createDataFrame([(1, "Hello مرحبا", "clash"), (1, "Hello مرحبا", None), (2, None, ""), (3, "", ""), (4, "long text " * 20_000, "")], "id bigint, t string, ids string")
    e = B.encode(d, "id", "t").cache()
    assert {r["id"]: len(r["ids"]) for r in e.collect()}[2] == 0 and e.count() == 5
    back = {r["id"]: r["text"] for r in B.decode(e, "id", "ids").collect()}
    assert back == {1: "Hello مرحبا", 2: "", 3: "", 4: "long text " * 20_000}
    assert {(r["id"], r["tokens"]) for r in B.encode(d, "id", "t", count_only=True).collect()} == {(r["id"], len(r["ids"])) for r in e.collect()}
    assert B.encode(d.limit(0), "id", "t").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 1), st.integers(0, 12)), max_size=40))
def test_packing_keeps_limits(items):
    limits = (20, 4, 12)
    box = P.pack(np.array(items, np.int64).reshape(-1, 3), limits)
    for b in set(box.tolist()):
        total = np.array(items)[box == b].sum(axis=0)
        assert (total <= limits).all()
    if items:
        assert len(set(box.tolist())) == box.max() + 1


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    n = np.minimum(4096, rng.geometric(1 / 400, 20_000)).astype(np.int64)
    box = P.pack(np.stack([n, np.ones_like(n), n], axis=1), (4096, 4096, 4096))
    assert (box.max() + 1) * 4096 <= n.sum() * 1.002 + 4096


def test_pack_frames(spark):
    d = spark.createDataFrame([(i, 1 + i * 7 % 90, "clash") for i in range(400)] + [(400, 0, ""), (401, 1000, None), (401, 1000, None)], "id bigint, tokens bigint, container string")
    items = P.split_items(d, "id", "tokens", None, 256)
    got = P.pack_items(items, "id", 256, max_segments=9, chunk=60).collect()
    assert len(got) == items.count() and sum(r["tokens"] for r in got) == sum(r["tokens"] for r in items.collect())
    used = {}
    for r in got:
        used.setdefault(r["container"], []).append(r["tokens"])
    assert all(sum(v) <= 256 and len(v) <= 9 for v in used.values()) and all(sum(used[r["container"]]) == r["used"] for r in got)
    assert [r["tokens"] for r in sorted((r for r in got if r["id"] == 401), key=lambda r: (r["piece"]))] == [256] * 6 + [232] * 2
    assert all(r["piece"] == 0 for r in got if r["id"] != 401)
    assert P.pack_items(items.limit(0), "id", 256).count() == 0
    again = P.pack_items(items.repartition(3), "id", 256, max_segments=9, chunk=60).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_packing_with_all_limits_binding():
    rng = np.random.default_rng(2)
    n = np.concatenate([rng.integers(1, 60, 9_000), rng.integers(200, 4_000, 3_000)])
    loss = np.where(rng.random(len(n)) < 0.2, 0, np.minimum(n, P.MAX_LOSS))
    limits = (P.CAPACITY, P.MAX_SEGMENTS, P.MAX_LOSS)
    box = P.pack(np.stack([n, np.ones_like(n), loss], axis=1), limits)
    for total, most in zip((np.bincount(box, n), np.bincount(box), np.bincount(box, loss)), limits, strict=True):
        assert total.max() <= most
    assert np.bincount(box).max() == P.MAX_SEGMENTS and np.bincount(box, loss).max() > P.MAX_LOSS - 8 and (box.max() + 1) * P.CAPACITY <= n.sum() * 1.03


def test_pack_texts_with_given_ones(spark):
    d = spark.createDataFrame([(i, "a b c " * (40 * i), "isnad" if i % 4 == 0 else None if i % 5 == 0 else "matn") for i in range(60)], "id bigint, t string, kind string")
    got = P.pack_texts(d, "id", "t", F.col("kind") == "isnad").cache()
    rows = {(r["id"], r["piece"]): r for r in got.collect()}
    assert all(r["loss"] == (0 if r["id"] % 4 == 0 else r["tokens"]) for r in rows.values())
    facts = {r[0]: r[1] for r in P.packing_facts(got, "id").collect()}
    assert facts.pop("texts placed") == 60 and len(facts) == 5 and not any(facts.values())
    broken = got.withColumn("container", F.lit("one"))
    facts = {r[0]: r[1] for r in P.packing_facts(broken, "id").collect()}
    assert facts["beyond capacity"] == facts["beyond segments"] == facts["beyond loss"] == facts["use misstated"] == 1


def test_pack_texts(spark):
    d = spark.createDataFrame([(1, "a b c " * 3000), (2, None), (3, ""), (4, "short")], "id bigint, t string")
    got = {(r["id"], r["piece"]): r["tokens"] for r in P.pack_texts(d, "id", "t").collect()}
    assert got[1, 0] == 4096 and got[2, 0] == 0 and got[3, 0] == 0 and got[4, 0] == 1 and max(got.values()) == 4096


PEOPLE = [
    ("1", "خالد بن طعيشة بن سذان المزثومي"), ("1", "أبو منموح المزثومي"), ("1", "Khālid ibn Tu'aysha ibn Sidhān al-Mazthūmī"), ("1", "Abū Manmūh al-Mazthūmī"),
    ("2", "محمد بن تماض الزحيبي"), ("2", "محمد بن تماض بن خوبم"), ("2", "Muhammad ibn Timād ibn Khawbam al-Zuhaybī"),
    ("3", "عبد الله بن طعيشة بن غوحث الهيركي"), ("3", "Abd Allah ibn Tu'aysha ibn Ghawhath al-Hayraki"), ("4", "حبيجة بن مثغوف العاتولي"), (None, "زيد بن عمرو"), ("5", None), ("6", ""),
]
SAME = {
    "خالد بن طعيشة المزثومي": "1", "خالد بن طعييشة بن سذان المزثومي": "1", "المزثومي، خالد بن طعيشة بن سذان": "1", "أبو منموح المزثومي": "1", "أبو منموح خالد بن طعيشة": "1", "الإمام خالد بن طعيشة بن سذان المزثومي رحمه الله": "1",
    "خالد بن طعيشة سذان مزثومي": "1", "K. ibn Tu'aysha ibn Sidhan al-Mazthumi": "1", "Mazthoomee, Khaalid bin Tu'aysha b. Sidhaan": "1", "KHALID BEN TU'AYSHA BEN SIDHAN, ABU MANMUH": "1", "Aboo Manmooh el-Mazthumi": "1",
    "محمد ب. تماض ب. خوبم الزحيبي": "2", "Muhammad ibn Timad al-Zuhaybi": "2", "عبدالله بن طعيشة بن غوحث": "3", "Abdullah ibn Tu'aysha Hayraki": "3", "حبيجة بن مثغوف العاتولي": "4",
}
OTHER = ["خالد", "رجل", "جده", "بعض أصحابنا", "a man", "محمد بن طعيشة بن سذان المزثومي", "خالد بن غوحث بن سذان المزثومي", "خالد بن سذان بن طعيشة المزثومي", "خالد بن طعيشة بن غوحث المزثومي", "أبو منموح", "", None, "Khalid", "ا" * 5000, "كلمة " * 300, "زيد بن عمرو"]


def test_variant_spellings(spark):
    given_ = [(f"s{i}", n) for i, n in enumerate([*SAME, *OTHER])]
    spelt = spark.createDataFrame([(*g, "clash") for g in given_ + given_[:3] + [(None, "خالد بن طعيشة المزثومي")]], "id string, name string, person string")
    persons = spark.createDataFrame([(*p, "clash") for p in PEOPLE + PEOPLE[:2]], "person string, name string, id string")
    got = {r["id"]: r["person"] for r in N.same_person(spelt, persons).collect()}
    assert got == {f"s{i}": SAME[n] for i, (_, n) in enumerate(given_) if n in SAME}
    assert N.same_person(spelt.limit(0), persons).count() == 0 and N.same_person(spelt, persons.limit(0)).count() == 0


def test_two_that_fit_alike_are_nobody(spark):
    persons = spark.createDataFrame([("1", "علي بن حسن بن زيد الكوفي"), ("2", "علي بن حسن بن عمر الكوفي")], "person string, name string")
    spelt = spark.createDataFrame([("a", "علي بن حسن الكوفي"), ("b", "علي بن حسن بن عمر الكوفي")], "id string, name string")
    assert {r["id"]: r["person"] for r in N.same_person(spelt, persons).collect()} == {"b": "2"}


def edits(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            rows[i].append(min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def test_index_finds_every_near_token():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abdh") for _ in range(rnd.randrange(2, 7))) for _ in range(60)]
    for a, b in itertools.combinations(words, 2):
        assert N.distance(a, b) == min(2, edits(a, b))
        if N.distance(a, b) <= 1 or N.distance(N.sound(a), N.sound(b)) <= 1:
            assert N.keys_of(a, False) & N.keys_of(b, True)
    for a, b in (("muhd", "muhammad"), ("abdr", "abdrahman"), ("khl", "khalil"), ("mo", "muhammad"), ("brahim", "ibrahim"), ("حماده", "احمد")):
        assert N.token_cost(a, b) == N.SHORTENED and N.keys_of(a, False) & N.keys_of(b, True)
    assert N.token_cost("md", "muhammad") == N.token_cost("hsyn", "hasan") == N.NO_ROLE


LINEAGE = "محمد بن عبد الله بن عمر بن علي بن حسن بن خالد بن سذان بن طعيشة"


def test_names_of_any_length_and_short_forms(spark):
    long = " بن ".join(f"اسم{chr(0x628 + i % 20)}{chr(0x628 + i // 20)}" for i in range(200))
    persons = spark.createDataFrame(
        [("1", LINEAGE + " البصري الحنفي"), ("2", "محمد بن عبد الله بن عمر بن علي بن زيد البصري"), ("3", "Muhammad ibn Abd al-Rahman ibn Khalil al-Basri"), ("3", "Muhammad ibn Abd al-Rahman ibn Khalil ibn Tamim ibn Harith"),
         ("4", "Ibrahim ibn Qasim al-Kufi"), ("5", long)], "person string, name string",
    )
    want = {
        LINEAGE: "1", "محمد بن عبد الله بن عمر بن علي بن حسن الحنفي": "1", "البصري، محمد بن عبد الله بن علي بن حسن بن خالد بن سذان": "1", "محمد بن عبدالله بن عمر بن علي بن زيد البصري": "2",
        "Muhd ibn Abd al-Rahman ibn Khalil ibn Tameem": "3", "M. ibn Abd al-Rahman ibn K. ibn Tamim ibn Harith al-Basri": "3", "Muhammad ibn Abdr ibn Khalil al-Basri": "3", "Brahim b. Qasim al-Kufi": "4", long: "5", long[: len(long) // 2].rsplit(" ", 2)[0]: "5",
    }
    other = [
        LINEAGE.replace("خالد", "زيد"), "محمد بن عبد الله بن عمر بن حسن بن علي البصري", "محمد بن عبد الله بن عمر بن علي البصري", "M. ibn A. al-Basri", "M. ibn K.", long + " بن غيره",
        " بن ".join(reversed(long.split(" بن "))), "اسم " * 3000,
    ]
    spelt = spark.createDataFrame([(str(i), n) for i, n in enumerate([*want, *other])], "id string, name string")
    got = {r["id"]: r["person"] for r in N.same_person(spelt, persons).collect()}
    assert got == {str(i): p for i, p in enumerate(want.values())}
