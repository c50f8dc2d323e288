"""What of a page is no article, and given columns with an operator's own names."""

import pytest

from daybook.llm import htmltext, langid, sharding

LONG = "Word and more words of the article that say a thing or two about the town and its people. "
P = f"<p>{LONG * 2}</p>"


def blocks(page):
    return htmltext.extract(page, htmltext.default_weights()).split("\n\n")


@pytest.mark.parametrize(
    ("page", "there", "gone"),
    [
        (f"<article data-title='the hidden gem'>{P}<p class='lead hidden treasure'>First {LONG}</p><p title='a hidden gem'>Second {LONG}</p></article>", ["First", "Second"], []),
        (f"<article>{P}<p hidden>One {LONG}</p><p aria-hidden=true>Two {LONG}</p><p style='color:red; display : none'>Three {LONG}</p></article>", [], ["One", "Two", "Three"]),
        (f"<article>{P}<form><p>Sign up for our newsletter. {LONG}</p></form><aside><p>Beside {LONG * 3}</p></aside><footer><p>About {LONG}</p></footer>{P}</article>", [], ["Sign", "Beside", "About"]),
        (f"<article>{P}<ul><li><a href=a>One source of the story</a></li><li><a href=b>Another source</a></li></ul>{P}</article>", ["One source of the story", "Another source"], []),
        (f"<article>{P}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be, press <button>OK</button> now</p></article>", ["Let x=2 be, press now"], ["OK"]),
    ],
)
def test_what_goes_and_what_stays(page, there, gone):
    found = blocks(page)
    assert LONG.strip().split()[0] in found[0]
    assert all(any(b.startswith(t) for b in found) for t in there)
    assert not any(g in b for g in gone for b in found)


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "the cat sat", "en", 0.5), (2, "le chat noir", "fr", 0.1)], "doc_id long, text string, lang string, score double")
    model = langid.fit(docs)
    found = langid.predict(docs.withColumnRenamed("lang", "lang_pred"), model, keep=["score", "lang_pred"])
    assert found.columns == ["doc_id", "score_given", "lang_pred_given", "lang_pred", "score"]
    assert {(r.doc_id, r.score_given, r.lang_pred_given) for r in found.collect()} == {(1, 0.5, "en"), (2, 0.1, "fr")}
    shards = sharding.shuffle_into_shards(docs.selectExpr("doc_id as shard", "text as slot", "lang as shard_given"), 2)
    assert shards.columns == ["shard_given_given", "slot_given", "shard_given", "shard", "slot"]
    assert {(r.shard_given_given, r.slot_given) for r in shards.collect()} == {(1, "the cat sat"), (2, "le chat noir")}
