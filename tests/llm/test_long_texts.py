"""Secret spans against a second implementation, and operators on texts of a megabyte."""

import random
import time

from glean.llm import secret_linking, suffix_dedup
from tests.llm.test_operators import prose

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def plain_spans(text):
    """The base spans character by character, without the patterns of the operator."""
    out, i = [], 0
    while i < len(text):  # assignments, leftmost and not overlapping; a failing match is passed over whole
        name = next((n for n in ("password", "passwd", "secret", "token", "api_key", "apikey") if text[i:i + len(n)].isascii() and text[i:i + len(n)].lower() == n), None)
        end = None
        if name:
            j = i + len(name)
            j += text[j:j + 1] in ('"', "'") and text[j:j + 1] != ""
            while text[j:j + 1] == " ":
                j += 1
            if text[j:j + 1] in (":", "=") and text[j:j + 1]:
                j += 1
                while text[j:j + 1] == " ":
                    j += 1
                j += text[j:j + 1] in ('"', "'") and text[j:j + 1] != ""
                k = j
                while k < len(text) and text[k] in VALUE:
                    k += 1
                if k > j:
                    end = k
                    if k - j >= 6:
                        out.append((i, 0, k))
        i = end or i + 1
    for kind, chars, head, least in ((1, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "AKIA", 20), (2, set("0123456789abcdef"), "", 24)):
        i = 0
        while i < len(text):
            k = i
            if text.startswith(head, i):
                k = i + len(head)
                while k < len(text) and text[k] in chars:
                    k += 1
            if k > i + len(head):
                if k - i >= least:
                    out.append((i, kind, k))
                i = k
            else:
                i += 1
    return sorted(out)


PARTS = ["password", "Secret", "api_key", "APIKEY", "token", ":", "=", " = ", '"', "'", " ", "\n", "hunter22x", "x", "AKIA", "ABCDEFGH01234567", "deadbeef" * 3, "0af", "ſecret",
         "user=alice", "https://a.b/c", "aB3dE5fG7hI9jK1lM3nO5", "-", "é"]


def texts(n=3000):
    rnd = random.Random(9)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(0, 25))) for _ in range(n)]


def test_base_spans_equal_a_plain_scan():
    hits = 0
    for t in texts():
        got = secret_linking.strong_spans(t)
        assert got == plain_spans(t)
        hits += len(got)
    assert hits > 1000


def test_weak_spans_touch_no_other():
    """Against comparing every candidate with every span taken before it."""
    for t in texts():
        strong = secret_linking.strong_spans(t)
        free = secret_linking.weak_spans(t, strong)
        taken = [(s, e) for s, _, e in strong]
        candidates = sorted(secret_linking.weak_spans(t, []) + free)
        for s, _, e in free:
            assert not any(a < e and s < b for a, b in taken)
            taken.append((s, e))
        for s, _, e in candidates:  # and none that could have been taken was left out
            assert any(a < e and s < b for a, b in taken)


def test_secrets_in_a_long_text_take_linear_time():
    line = "user=alice{0} key aB3dE5fG7hI9jK1lM3nO{0} at https://host{0}.example/x password = hunter{0}zz\n"
    text = "".join(line.format(k) for k in range(14_000))
    assert len(text) > 1 << 20
    began = time.time()
    strong = secret_linking.strong_spans(text)
    weak = secret_linking.weak_spans(text, strong)
    assert time.time() - began < 20 and len(strong) == 14_000 and len(weak) == 3 * 14_000


def test_two_equal_texts_of_a_megabyte_are_removed(spark):
    long_ = prose(80, 200_000)
    other = prose(81, 500)
    docs = spark.createDataFrame([(1, long_), (2, long_ + " " + other), (3, other[:300])], "doc_id long, text string")
    began = time.time()
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).drop("kept").collect()}
    assert len(long_) > 800_000 and time.time() - began < 90
    assert (got[1]["n_removed"], got[1]["n_spans"]) == (len(long_), 1)
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (len(long_), 1) and got[3]["n_removed"] == 0
