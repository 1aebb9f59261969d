"""Personal data and secrets against the patterns as they are stated."""

import base64
import random
import re

from takerlens.llm import op1_pii, op3_secrets
from tests.llm.conftest import babble


def stated_personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], op1_pii.KINDS.index(s[0])))


def test_base_spans_are_the_stated_ones():
    parts = ["a", "@", ".", "1", "25", "0", "-", " ", "+", "(", ")", "b@c.d", "4111111111111111", "%", "é", "255", "256"]
    for text in babble(parts, 6000, 40, 5):
        assert op1_pii.plain_spans(text) == stated_personal(text), text


def test_disguises_map_to_their_source():
    cases = {
        "write to jane (at) mail (dot) example (dot) com now": ("email", "jane (at) mail (dot) example (dot) com"),
        "jane.doe at mail dot example dot com.": ("email", "jane.doe at mail dot example dot com"),
        "ask bob[at]x.org, please": ("email", "bob[at]x.org"), "user@host[.]com": ("email", "user@host[.]com"),
        "j​ohn@ex​ample.com": ("email", "j​ohn@ex​ample.com"), "аnna@exаmple.com hi": ("email", "аnna@exаmple.com"),
        "call plus 1 (386) 555-3733!": ("phone", "plus 1 (386) 555-3733"),
        "+one three eight six five five five three seven three three": ("phone", "+one three eight six five five five three seven three three"),
        "pay ４１１１ １１１１ １１１１ １１１１ today": ("card", "４１１１ １１１１ １１１１ １１１１"), "host 10(.)0(.)0(.)1": ("ip", "10(.)0(.)0(.)1"),
    }
    for text, (kind, source) in cases.items():
        assert [(k, text[a:b]) for k, a, b in op1_pii.added_spans(text, op1_pii.plain_spans(text))] == [(kind, source)], text
    for clean in ("we met at noon. then at example.com we", "look at the mail", "i was at home dot dot", "two or three of one",
                  "one two three four five six", "éa b­c", ""):
        assert op1_pii.added_spans(clean, op1_pii.plain_spans(clean)) == [], clean


def test_short_runs_of_spelled_digits_and_bare_at():
    cases = {
        "host one nine two dot one six eight dot zero dot one up": ("ip", "one nine two dot one six eight dot zero dot one"),
        "server 10.0.0.one": ("ip", "10.0.0.one"),
        "call +1 four one five 555 0132 now": ("phone", "+1 four one five 555 0132"),
        "plus one (four one five) five five five zero one three two":
            ("phone", "plus one (four one five) five five five zero one three two"),
        "pay 4111 1111 1111 one one one one": ("card", "4111 1111 1111 one one one one"),
        "ask jane.doe at example.com today": ("email", "jane.doe at example.com"),
        "ask jane at mail.example dot com": ("email", "jane at mail.example dot com"),
        "ask jd42 at mail.example.com": ("email", "jd42 at mail.example.com"),
    }
    for text, (kind, source) in cases.items():
        assert [(k, text[a:b]) for k, a, b in op1_pii.added_spans(text, op1_pii.plain_spans(text))] == [(kind, source)], text
    for clean in ("one of two, three at home", "one day at example.com", "version one.two or one.two.three", "room one at 10.30",
                  "call 555 0132 or one of two", "follow-up at example.com"):
        assert op1_pii.added_spans(clean, op1_pii.plain_spans(clean)) == [], clean


def test_every_rewritten_character_has_a_place():
    rng = random.Random(2)
    for source in babble("abcd", 300, 30, 1):
        tape = op1_pii.Tape(source)
        for _ in range(3):
            edits, at = [], 0
            while at < len(tape.text):
                lo = at + rng.randint(0, 4)
                at = min(len(tape.text), lo + rng.randint(1, 3))
                if lo < at:
                    edits.append((lo, at, rng.choice(["", "X", "YZ"])))
            tape = tape.rewrite(iter(edits))
        for k, char in enumerate(tape.text):
            a, b = tape.source(k, k + 1)
            assert 0 <= a <= b <= len(source) and (char not in "abcd" or source[a] == char and b > a)


def test_personal_data_of_a_table(stored, samples):
    docs = stored(samples + [(7, "mail a@b.co or c (at) d (dot) org")])
    got = {r.doc_id: r for r in op1_pii.find_personal_data(docs).collect() if r.doc_id is not None}
    assert got[7].spans == "email:5:11,email:15:33" and (got[7].n_email, got[7].n_added) == (1, 1)
    assert got[9001].spans == got[9002].spans == ""
    assert sum(1 for _ in op1_pii.find_personal_data(docs).collect()) == len(samples) + 1
    masked = op1_pii.mask_personal_data(docs)
    assert masked.columns == docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[7] == "mail <email> or <email>" and texts[9001] is None and texts[9002] == ""


def stated_secrets(text):
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    out = [("assign", *m.span()) for m in re.finditer(rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)
           if len(m[1]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], op3_secrets.KINDS.index(s[0])))


def test_base_secrets_are_the_stated_ones():
    parts = ["password", "PassWd", "secret", "toKen", "ſecret", "toKen", "api_key", "APIKEY", "=", " ", ":", '"', "'", "abcdefgh",
             "0123456789abcdef", "AKIA", "AKIAABCDEFGH1234", "xyz=", "/", "é", "\n"]
    for text in babble(parts, 5000, 14, 4):
        assert op3_secrets.base_spans(text) == stated_secrets(text), text


def random_key(rng, n):
    return base64.b64encode(rng.randbytes(n)).decode().rstrip("=")[:n]


def test_words_are_not_random_and_keys_are():
    rng = random.Random(1)
    for words in ("usr/local/lib/python/site-packages", "Donaudampfschifffahrtsgesellschaft", "this_is_a_long_identifier_name",
                  "550e8400-e29b-41d4-a716-446655440000", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa"):
        assert op3_secrets.evidence(words) < 2, words
    strong = [op3_secrets.evidence(random_key(rng, 40)) for _ in range(50)]
    assert sorted(strong)[5] > 4


def test_false_discoveries_are_held_by_length():
    # 1000 dull tokens of each length; one strong find passes where the evidence carries it.
    counts = {(9, 0): 1000, (11, 0): 1000, (9, 4 * 3): 1, (11, 4 * 12): 1}
    assert op3_secrets.discovered(counts, 1e-3) == {11: 25}


def test_secrets_of_a_table(stored, samples):
    rng = random.Random(3)
    keys = [random_key(rng, 44) for _ in range(20)]
    rows = samples + [(30_000 + i, f"the value {k} is here") for i, k in enumerate(keys)] + [(31_000, "token = abcdefgh1")]
    docs = stored(rows)
    out = op3_secrets.find_secrets(docs).collect()
    got = {r.doc_id: r for r in out if r.doc_id is not None}
    assert len(out) == len(rows) and got[31_000].spans == "assign:0:17"
    assert sum(got[30_000 + i].spans == f"random:10:{10 + len(k)}" for i, k in enumerate(keys)) >= 15
    assert all(r.n_random == 0 for i, r in got.items() if i < 9001)
    assert op3_secrets.find_secrets(docs.limit(0)).count() == 0
