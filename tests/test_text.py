"""Literal cases for URL, cleaning and tokenising expressions."""

import re

import pytest
from pyspark.sql import functions as F

from feedloom.functions import text as tx
from feedloom.functions import urls as ux


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("http://www.sankeisquare.com/ev)ent/kanjicontest_5th,)", "http://www.sankeisquare.com/event/kanjicontest_5th"),
        ("http://fast.ai’s", "http://fast.ai"),
    ],
)
def test_clean_url(one, raw, expected):
    assert one(ux.clean_url, raw) == expected


@pytest.mark.parametrize(
    "url, expected",
    [
        ("ttps://www.telegraph.co.uk/technology/2020/12/08/x/", "telegraph.co.uk"),
        ("http://edition.cnn.com/WORLD/fringe/9603/03-27/index.html", "cnn.com"),
        ("https://www.rnz.co.nz/national/programmes/x", "rnz.co.nz"),
        ("http://cnn.com.", "cnn.com."),
        ("http://a.b.cnn.com/x", "b.cnn.com"),
        ("no link", ""),
        ("//cnn.com/x", "cnn.com"),
    ],
)
def test_url_domain(one, url, expected):
    assert one(ux.url_domain, url) == expected


def test_host_links_go_before_urls_are_read(one):
    text = "the endpoint is: https://api.twitter.com/fleets/v1/user_fleets?user_id="
    assert one(lambda c: ux.extract_urls(ux.strip_host_urls(c)), text) == []


def test_nested_host_link_keeps_the_outer_prefix(one):
    text = "https://api.twitter.com/https://twitter.com/z tail"
    assert one(ux.strip_host_urls, text) == "https://api.twitter.com/ tail"


def test_short_links(one):
    twice = lambda c: ux.strip_short_links(ux.strip_short_links(c))
    assert one(twice, "https://www.google.com/amp/s/bit.ly/q ok") == " ok"
    assert one(ux.strip_short_links, "https://t.co/a　tail") == "　tail"


def test_short_links_go_and_wrappers_open(one):
    cases = {
        "https://www.google.com/amp/s/bit.ly/q ok": "https://bit.ly/q ok",
        "see https://bit.ly/1 and http://buff.ly/2 end": "see  and  end",
        "www.google.com/amp/s/www.cnn.com/x": "www.cnn.com/x",
        "https://t.co/abc\nnext line": "\nnext line",
        "nothing here": "nothing here",
    }
    assert one(ux.strip_short_links, *cases) == list(cases.values())


def test_long_url_does_not_overflow(one):
    assert len(one(ux.extract_urls, "http://" + "a" * 100_000)) == 1


def test_extract_urls_alphabet(one):
    assert one(ux.extract_urls, "x http://a.b/c_d https://e.f/g%20h?i") == ["http://a.b/c", "https://e.f/g%20h"]


def test_news_flag_of_null_and_plain_text(one):
    flag = lambda c: ux.news_flag(c, ["cnn.com"])
    assert one(flag, None, "plain", "http://edition.cnn.com/x", "http://cnn.com.") == [0, 0, 1, 0]


def test_drop_empty(spark):
    df = spark.createDataFrame([(["", "abc"],), (["", "", "a"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(ux.drop_empty(F.col("a"))).collect()] == [["abc"], ["a"], []]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('@you "Paper-paper citations, and so forth"', "paper-paper citations and so forth ''"),
        ("RT: Apple's app store (fails) http://x.y/z", "rt apple 's app store fails"),
        ("12 meanwhile in canada..", "meanwhile in canada .."),
        ("I don't know. You cannot go!", "do know you can not go"),
        ("Dr. Smith met Mr. Jones. Then left.", "dr. smith met mr. jones then left"),
        ("the u.s. army is in the u.s.", "the u.s. army is in the u.s"),
        ("He left (at last.) Then 'stop.' and so on...", "he left at last then 'stop and so on ..."),
        ("創作漢字 kanji", "kanji"),
        ("", ""),
    ],
)
def test_clean_text(one, raw, expected):
    assert one(tx.clean_text, raw) == expected


def test_negation_is_expanded_in_the_other_mode(one):
    assert one(lambda c: tx.clean_text(c, "expand"), "I don't know") == "do not know"
    with pytest.raises(ValueError):
        tx.normalise(F.col("x"), "other")


def test_tokens(one):
    found = one(tx.treebank_tokens, "He said \"stop\", didn't he? (yes--no) it's $5.")
    assert found == ["He", "said", "``", "stop", "''", ",", "did", "n't", "he", "?", "(", "yes", "--", "no", ")", "it", "'s", "$", "5", "."]


def test_word_tokens_keep_other_scripts(one):
    assert one(tx.word_tokens, "Größe a it's x_1 漢字") == ["größe", "it", "x_1", "漢字"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    found = [r[0] for r in df.select(tx.ngrams(F.col("t"))).collect()]
    assert found == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_containment(one):
    any_of = lambda words, cs=False: (lambda c: tx.contains_any(c, words, cs))
    assert one(any_of(["ToKen"]), "a token", "TOKENS", None, "none") == [True, True, False, False]
    assert one(any_of(["Rep."], True), "Rep. X", "rep. x", "Repx") == [True, False, False]
    assert one(any_of([""]), "x") is True
    assert one(any_of([]), "x") is False
