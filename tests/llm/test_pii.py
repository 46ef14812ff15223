import hashlib
import random
import re

from corpusloom.llm import pii as P
from corpusloom.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def naive(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_query(spark, sf, docs):
    rows = {r.doc_id: r for r in QUERIES["op2_pii"](spark, sf).collect()}
    assert len(rows) == len(docs)
    for d, t, _ in docs:
        want = naive(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        r = rows[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in P.KINDS)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_patterns_match_plain_regular_expressions():
    rng = random.Random(6)
    alphabet = "ab@.-_+%1234567890 ()é,:"
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert P.pattern_spans(text) == naive(text), text
    for text in ("a@b.c_d@e.f", "x@y@z.w", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.255", "256.1.1.1", "4111 1111-1111 1111 ", "+1 (988) 555-2485 and", "+1((((", "@a.b", "٣@a.b 1٣.1.1.1"):
        assert P.pattern_spans(text) == naive(text), text


def test_long_runs_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "a" * 100_000 + "@" + "b" * 100_000):
        assert all(k == "ip" for k, _, _ in P.pattern_spans(text))


FILL = "lorem ipsum dolor amet consectetur adipiscing elit tempor incididunt labore magna aliqua veniam quis nostrud".split()


def planted(n=40):
    """A name that stands next to one address only, in different surroundings; all other words are everywhere."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [rng.choice(FILL) for _ in range(30)]
        if i < 5:
            words[10:12] = ["Zebulon", "write", "zeb@mail.example.com"]
        elif i < 8:
            words[10:12] = ["zebra@mail.example.com"]
        rows.append((i, " ".join(words)))
    return rows


def test_disclosing_terms(spark):
    df = spark.createDataFrame(planted(), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in P.span_digest(df).collect()}
    text = dict(planted())
    for i in range(5):
        at = text[i].index("Zebulon")
        assert f"remove:{at}:{at + 7}" in rows[i]
    assert all(("remove" in s or "generalise" in s) == (i < 5) for i, s in rows.items())
    clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert "Zebulon" not in clean[0] and "[EMAIL]" in clean[0] and clean[20] == text[20]


def test_copies_are_no_evidence(spark):
    rows = [(i, "Hapax legomenon next to one@mail.example.com once") for i in range(9)]
    got = P.span_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.spans for r in got} == {P.spans_text(naive(rows[0][1]))}


def naive_added(rows, support=3):
    """Added spans of every row by counting over dictionaries of whole documents."""
    docs = {(d, t or ""): None for d, t in rows}
    word = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
    df, have, around = {}, {}, {}
    for key in docs:
        base = [(a, b) for _, a, b in naive(key[1])]
        free = [(m.group().lower(), m.start(), m.end()) for m in word.finditer(key[1]) if len(m.group()) > 2 and not any(a < m.end() and m.start() < b for a, b in base)]
        docs[key] = free
        for w in {w for w, _, _ in free}:
            df[w] = df.get(w, 0) + 1
        for k, a, b in naive(key[1]):
            v = key[1][a:b]
            e = (k, v.lower() if k == "email" else tuple(int(x) for x in v.split(".")) if k == "ip" else re.sub("[^0-9]", "", v))
            have.setdefault(e, set()).add(key)
            near = [w for w, _, end in free if end <= a][-8:], [w for w, at, _ in free if at >= b][:8]
            around.setdefault((e, key), set()).add(str(near[0] + near[1]))
    kinds: dict = {}
    for e, keys in have.items():
        words = {}
        for key in keys:
            for w in {w for w, _, _ in docs[key]}:
                words.setdefault(w, set()).add(key)
        for w, seen in words.items():
            if min(len(seen), len(set().union(*(around[e, k] for k in seen)))) >= support and 4 * len(seen) >= df[w]:
                for key in seen:
                    kinds[key, w] = "remove" if 2 * len(seen) >= df[w] or kinds.get((key, w)) == "remove" else "generalise"
    return {(d, t): {f"{kinds[(d, t or ''), w]}:{a}:{b}" for w, a, b in docs[d, t or ""] if ((d, t or ""), w) in kinds} for d, t in rows}


def added(r):
    return {s for s in r.spans.split(",") if s.split(":")[0] in ("remove", "generalise")}


def test_added_spans_against_brute_force(spark, docs):
    rng = random.Random(9)
    rows = [(d, t) for d, t, _ in docs] + [(10_000 + i, t) for i, t in planted()]
    for i in range(60):  # entities met in many documents, names at any distance, several entities a document
        words = [rng.choice(FILL) for _ in range(rng.randint(5, 120))]
        who = rng.randint(0, 4)
        for w in (f"Person{'abcde'[who]}", f"p{who}@mail.example.com", rng.choice(["+1 (988) 555-2485", "10.0.0.1", f"p{rng.randint(0, 4)}@mail.example.com"])):
            words.insert(rng.randint(0, len(words)), w)
        rows.append((20_000 + i, " ".join(words)))
    rows += rows[-5:]
    want = naive_added(rows)
    got = P.span_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    text = dict(rows)
    assert len(got) == len(rows) and sum(map(len, want.values())) > 60
    assert all(added(r) == want[r.doc_id, text[r.doc_id]] for r in got)


def test_a_name_far_from_the_address_is_found(spark):
    rng = random.Random(2)
    filler = lambda n: " ".join(rng.choice(FILL) for _ in range(n))
    rows = [(i, f"Zebulon {filler(30)} zeb@mail.example.com {filler(20)}") for i in range(6)] + [(i, filler(60)) for i in range(6, 60)]
    got = {r.doc_id: added(r) for r in P.span_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(("remove:0:7" in s) == (i < 6) for i, s in got.items())


def test_quoted_words_are_counted_like_others(spark):
    rng = random.Random(3)
    rows = [(i, " ".join([*(rng.choice(FILL) for _ in range(20)), "'status'", "x@mail.example.com" if i < 5 else "", *(rng.choice(FILL) for _ in range(9))])) for i in range(40)]
    assert all(not added(r) for r in P.span_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_repeated_rows_are_one_document(spark):
    rows = planted()
    once = {r.doc_id: r.spans for r in P.span_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    five = P.span_digest(spark.createDataFrame(rows * 5, "doc_id long, text string")).collect()
    assert len(five) == 5 * len(rows) and all(r.spans == once[r.doc_id] for r in five)
    assert any("remove" in s for s in once.values())


def test_very_long_texts_are_marked(spark):
    rows = [(i, f"Zebulon {'lorem ' * (40_000 + i)}{'ipsum dolor amet'.split()[i]} zeb@mail.example.com elit" + " tail" * i) for i in range(3)]
    got = {r.doc_id: added(r) for r in P.span_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = naive_added(rows)
    assert all(got[i] == want[i, t] and "remove:0:7" in got[i] for i, t in rows)


def test_edges(spark, weird, nothing):
    rows = P.span_digest(weird.withColumnRenamed("lang", "spans")).collect()
    assert len(rows) == 11 and all(r.spans == "" for r in rows)
    assert P.sanitise(weird).columns == weird.columns
    assert sorted(map(str, P.sanitise(weird).select("doc_id", "text").collect())) == sorted(map(str, weird.select("doc_id", "text").collect()))
    assert P.span_digest(nothing).count() == 0


def test_cleaned_text_merges_overlaps():
    assert P.cleaned_text("abcdefgh", [("card", 1, 4), ("phone", 2, 6), ("remove", 7, 8)]) == "a[CARD]g"
