"""Measures against plain definitions and DuckDB, and the cascades."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from atlasweave.functions import similarity as s

word = st.text(alphabet="abcd ", max_size=10)


def plain_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] + 1 if x == y else max(last[j], row[j - 1]))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(word, word)
def test_edit_measures(a, b):
    assert s.levenshtein_distance(a, b) == plain_levenshtein(a, b)
    assert s.lcs_length(a, b) == plain_lcs(a, b)
    assert s.jaro_winkler(a, b) >= s.jaro(a, b) - 1e-9
    for f in (s.ratio, s.partial_ratio, s.token_ratio, s.partial_token_ratio, s.seq_ratio, s.seq_token_set_ratio):
        assert 0 <= f(a, b) <= 100
        assert f(a, a) == 100 or not a.strip()


def test_jaro_against_duckdb():
    con = duckdb.connect()
    for a, b in (("ddbba", "dcdcac"), ("martha", "marhta"), ("dixon", "dicksonx"), ("abc", "xyz"), ("a", "a")):
        x, y = con.execute("SELECT jaro_similarity(?, ?), jaro_winkler_similarity(?, ?)", [a, b, a, b]).fetchone()
        assert abs(s.jaro(a, b) / 100 - x) < 1e-9
        assert abs(s.jaro_winkler(a, b) / 100 - y) < 1e-9


def test_token_measures():
    assert s.token_ratio("new york mets", "mets york new") == 100
    assert s.token_set_ratio("kaya", "kaya centre") == 100
    assert s.partial_ratio("kaya", "centre kaya sante") == 100
    assert s.partial_token_ratio("kaya x", "y kaya") == 100
    assert s.token_set_ratio("", "a") == 0
    assert s.seq_token_sort_ratio("Kaya Centre", "centre, kaya") == 100


def test_cascades():
    assert s.match_rapid("Kaya", ["Kaya"]) == ("Kaya", 100.0, "identical", "YES")
    assert s.match_rapid("Kaya", ["Kayo"]) == ("Kayo", 75.0, "levenshtein", "YES")
    assert s.match_rapid("Kaya", [])[3] == "NO"
    assert s.match_rapid("Kaya Centre", ["Centre Kaya", "Zzz"])[2:] == ("token_ratio", "YES")
    assert s.match_rapid("abcdef", ["uvwxyz"])[2:] == ("levenshtein", "NO")
    assert s.match_sequence("Kaya Center", ["Center Kaya"])[2:] == ("fuzz_token_ratio", "YES")
    assert s.match_rapid("Kaya", ["Kayo", "Kayu"])[0] == "Kayo"  # the first of equals
