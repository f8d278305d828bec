import hashlib
import math
import random
import re
import time
from collections import defaultdict

import regex

from tidemark.llm import pii

# The contract's own patterns, as a plain search uses them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "a@b.c_d@e.fg x@y a@@b.c 1.2.3.4.5 001.002.3.255 256.1.1.1 é 4111 1111-1111 1111 41111111111111112 +1 (415) 555-0100. +1 2 +((5",
    "", None, "@" * 50, "9" * 500 + " " + "1.1" * 40, "éa@b.co😀 10.0.0.1 z@q.io 0.0.0.0 00.1.1.1 1.1.1.1000", "1" * 60_000 + "@", "a@b" + ".c" * 20_000,
    "4111111111111111", "4111-1111-1111-1111 4111  1111 1111 1111", "+" * 30 + "4930123456" + " 7" * 3000, "x.y@z.example, +49 30 123456-78",
]


def luhn(digits):
    values = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {
        "email": True,
        "ip": kind != "ip" or all(int(p) <= 255 for p in text.split(".")),
        "card": 16 <= len(digits) <= 19 and luhn(digits),
        "phone": 8 <= len(digits) <= 15,
    }[kind]


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_base_spans_equal_a_plain_search(spark, folder, frame):
    rows = [(i, t, 1, "c") for i, t in enumerate(ODD)] + [(3, ODD[0], 1, ""), (None, ODD[0], 1, "")]
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text", "1 AS base", "'c' AS rid")
    docs = frame(rows, "doc_id long, text string, base int, rid string").unionByName(docs)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(plain_spans(r["text"]))
    found = pii.digest(pii.find(docs)).collect()
    assert len(found) == docs.count()
    for r in found:
        match = [s for s in texts[r["doc_id"]] if hashlib.sha256(",".join(s).encode()).hexdigest() == r["base_sha256"]]
        assert match and r["spans"].startswith(",".join(match[0]))
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s.startswith(k) for s in match[0]) for k in PLAIN]


def test_terms_that_give_an_entity_away(frame):
    filler = "some plain words about weather and trade"
    rows = [(i, f"{filler} number {'abcdefghij'[i % 10] * 4} text") for i in range(60)]
    rows += [(100 + i, f"{filler} Zanzibar office writes boss@corp.example about weather {'qrst'[i] * 5}") for i in range(3)]
    rows += [(200, "Zebra alone mail one@two.example"), (201, None)]
    docs = frame(rows, "doc_id long, text string")
    by_id = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    text = dict(rows)
    for i in (100, 101, 102):
        terms = [s.split(":") for s in by_id[i]["spans"].split(",") if s.startswith("term")]
        words = {text[i][int(a) : int(b)] for _, a, b in terms}
        assert "Zanzibar" in words and "office" in words and not words & {"weather", "about", "plain"}
    assert "term" not in by_id[200]["spans"] and by_id[5]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs.selectExpr("*", "1 AS base")).collect()}
    assert clean[5] == text[5] and clean[201] is None
    assert "Zanzibar" not in clean[100] and "[EMAIL]" in clean[100] and "weather" in clean[100]
    assert clean[200] == "Zebra alone mail [EMAIL]"


def test_length_follows_the_text(frame):
    docs = frame([(1, "x boss@corp.example y", 21), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    got = sorted(tuple(r) for r in pii.sanitise(docs).collect())
    assert got == [(1, "x [EMAIL] y", 11), (2, "clean", 5), (3, None, None)]


def test_empty_table_and_native_plan(frame):
    found = pii.find(frame([], "doc_id long, text string"))
    assert found.count() == 0
    assert "Python" not in found._jdf.queryExecution().toString()


def test_terms_are_counted_and_marked_in_whole_documents(frame):
    filler = "some plain words about weather and trade"
    rows = [(i, f"{filler} number {'abcdefghij'[i % 10] * 4} text corp") for i in range(60)]
    rows += [(100 + i, f"Kestrel {'qrst'[i] * 5} QX n7x4 {filler * 4} boss@corp.example") for i in range(3)]
    rows += [(200, "The Kestrel flies")]
    docs = frame(rows, "doc_id long, text string")
    text = dict(rows)
    marked = {
        r["doc_id"]: {text[r["doc_id"]][int(a) : int(b)] for s in r["spans"].split(",") if s.startswith("term") for _, a, b in [s.split(":")]}
        for r in pii.digest(pii.find(docs, generalise=0.85)).collect()
    }
    assert all({"Kestrel", "QX", "n7x4"} <= marked[i] and not marked[i] & {"plain", "weather"} for i in (100, 101, 102))
    assert marked[200] == {"Kestrel"} and not any(marked[i] for i in range(60))

def _plain_entities(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return {f"email:{value.lower()}", "email:@" + value.lower().rsplit("@", 1)[1]}
    if kind == "ip":
        return {f"ip:{value}", "ip:" + ".".join(value.split(".")[:3]) + ".*"}
    return {f"{kind}:{digits}", f"{kind}:{digits[:6]}*"}


def _plain_terms(texts, generalise):
    """Terms and their greatest share, from the definition: each pair of a term and an entity."""
    with_term, with_entity = defaultdict(set), defaultdict(set)
    for i, text in enumerate(texts):
        text = text or ""
        blank = list(text)
        for s in plain_spans(text):
            kind, a, b = s.split(":")
            for e in _plain_entities(kind, text[int(a) : int(b)]):
                with_entity[e].add(i)
            blank[int(a) : int(b)] = " " * (int(b) - int(a))
        for word in regex.findall(r"[\p{L}\p{M}\p{N}]+", "".join(blank).lower()):
            if len(word) > 1:
                with_term[word].add(i)
    found = {}
    for docs in with_entity.values():
        for term, there in with_term.items():
            both = docs & there
            if len({texts[i] for i in both}) < 2:
                continue
            pmi = math.log(len(both) * len(texts) / (len(docs) * len(there)))
            held = math.log(len(texts) / len(docs))
            share = pmi / held if held > 0 else 0
            if share >= generalise:
                found[term] = max(found.get(term, 0), share)
    return found


def _planted(rng):
    common = [f"common{'abcdefgh'[i]}" for i in range(8)]
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    firms = [(f"firm{c}.example", f"Secret{c}", f"10.{i}.7", f"+4930{i}12") for i, c in enumerate("abcdef")]
    texts = []
    for n in range(400):
        parts = [*rng.choices(common, k=6), *rng.choices(words, k=12)]
        if n % 8 == 0:
            domain, secret, net, phone = firms[n // 8 % len(firms)]
            mark = [f"p{n}@{domain}", f"{net}.{n % 250}", f"{phone} {n:05d}"][n // 48 % 3]
            parts += [mark, secret + "uvw"[n // 48 % 3], f"Desk{n // 100}"]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    return [*texts, *texts[:20], None, "", "boss@firma.example 😀 Secretau,x", texts[8] + " more"]


def test_terms_equal_the_measure_of_every_pair(frame):
    texts = _planted(random.Random(4))
    docs = frame(list(enumerate(texts)), "doc_id int, text string")
    for generalise in (0.7, 0.9):
        want = _plain_terms(texts, generalise)
        assert any(w.startswith("secret") for w in want) and not any(w.startswith("common") for w in want)
        for r in pii.find(docs, generalise=generalise).collect():
            text = texts[r["doc_id"]] or ""
            base = [(s["start"], s["end"]) for s in r["base"]]
            blank = list(text)
            for a, b in base:
                blank[a:b] = " " * (b - a)
            hits = [m for m in regex.finditer(r"[\p{L}\p{M}\p{N}]+", "".join(blank)) if m.group().lower() in want]
            assert [(s["start"], s["end"], s["value"]) for s in r["terms"]] == [(m.start(), m.end(), m.group()) for m in hits]
            removed = {m.group().lower() for m in hits if want[m.group().lower()] >= pii.REMOVE}
            assert set(r["removed"]) == removed


def test_many_spans_in_one_text(frame):
    """Time that grows with the text, not with its square; two texts full of shared addresses
    are one pair of documents, not a product of addresses and words."""
    many = " ".join(f"user{i}@host{i % 50}.example word{i:x}z" for i in range(16_000))
    docs = frame([(1, many), (2, many + " x"), (3, "clean text")], "doc_id int, text string")
    started = time.time()
    found = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert time.time() - started < 120
    assert found[1]["n_email"] == 16_000 and found[3]["spans"] == "" and clean[3] == "clean text"
    assert "@" not in clean[1] and clean[1].count("[EMAIL]") == 16_000


def test_overlapping_spans_are_replaced_once(frame):
    texts = ["a +1 2.3.4.5 4111111111111111 b", "😀 +4930 10.0.0.1 77 4111-1111-1111-1111 c", "1.2.3.4@x.example"]
    docs = frame(list(enumerate(texts)), "doc_id int, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}

    def plain(text):
        spans = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in plain_spans(text)))
        out, at = "", 0
        for a, b, kind in spans:
            if a >= at:
                out += text[at:a] + f"[{kind.upper()}]"
            at = max(at, -b)
        return out + text[at:]

    assert clean == {i: plain(t) for i, t in enumerate(texts)}
