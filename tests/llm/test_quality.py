from collections import Counter

import pytest
from pyspark.sql import functions as F

from odometrix.llm.quality import clean_lines
from tests.llm.helpers import WORD, documents, hard_rows, words


def base(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often = Counter(grams)
    inside = {k + d for k, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)
    )


PROSE = "A clean line of prose that says something with a good number of words in it."


def line(i):
    return " ".join(f"word{i}x{k}" for k in range(9)) + "."


JUNK = [
    (1, "\n".join([PROSE] * 2 + [line(i) for i in range(9)]), "s"),
    (2, " | ".join(f"menu{i}" for i in range(80)), "s"),
    (3, " ".join(f"word{i}###" for i in range(90)), "s"),
    (4, "\n".join([line(i) for i in range(12)] + ["All rights reserved."]), "s"),
    (5, "\n".join(f"Copyright {i}. All rights reserved by the owners of this." for i in range(40)), "s"),
    (6, "a b c a b c a b\n" * 30, "s"),
    (7, "== -- !! ?? ,, .. " * 40, "s"),
]


def test_base_statistics_match_brute_force(spark):
    rows = hard_rows() + JUNK
    got = clean_lines(documents(spark, rows)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_verdicts_and_cleaned_lines(spark):
    got = {r.doc_id: r for r in clean_lines(documents(spark, JUNK)).select("doc_id", "text", "quality.*").collect()}
    assert [got[i].kept for i in range(1, 8)] == [True, False, False, True, False, False, False]
    assert got[1].clean_text == got[1].text and got[1].lost_words == 0
    assert got[4].clean_text == got[4].text.rsplit("\n", 1)[0] and got[4].lost_words == 3
    assert got[2].lost_lines.navigation == 1 and got[3].lost_lines.punctuation == 1
    assert got[5].lost_lines.boilerplate == 40


NOTICES = """Released under the MIT License.
Licensed under CC BY-NC 4.0.
This work is licensed under the GNU General Public License, version 3.
Distributed under the terms of the BSD 3-Clause License.
Copyright (c) 2021 The Authors
© 2019 Example Verlag GmbH
SPDX-License-Identifier: Apache-2.0
Alle Rechte vorbehalten.
Veröffentlicht unter der MIT-Lizenz.
Dieses Werk ist lizenziert unter CC BY-SA 4.0.
Datenschutzerklärung und Impressum
Diese Website verwendet Cookies.
TOUS DROITS RÉSERVÉS
Publié sous licence Creative Commons.
Mentions légales – Conditions d’utilisation
Nous utilisons des cookies pour votre confort.
Todos los derechos reservados.
Publicado bajo la licencia MIT.
Política de privacidad y aviso legal
Este sitio web utiliza cookies propias.""".split("\n")

PLAIN = """The court weighed copyright law against the right to quote.
She passed the driving licence test under heavy rain.
Die Fahrer fuhren mit Lizenz und ohne Angst durch die Stadt.
Der Impresario bat um Ruhe und um mehr Rechte.
Les droits des auteurs furent défendus devant la cour.
Los derechos de los vecinos fueron reservados para otra sesión.
The blog in town wrote about cookies that we use for tea.""".split("\n")


def test_notices_in_four_languages(spark):
    body = [line(i) for i in range(60)]
    text = "\n".join(body + NOTICES + PLAIN)
    got = clean_lines(documents(spark, [(1, text, "s")])).select("quality.*").first()
    assert got.kept and got.lost_lines.boilerplate == len(NOTICES)
    assert got.clean_text.split("\n") == body + PLAIN


def test_no_shuffle_and_empty(spark):
    df = clean_lines(documents(spark, JUNK).coalesce(1))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan
    assert clean_lines(documents(spark, JUNK).limit(0)).count() == 0


def test_clean_documents_of_the_tables_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    labels = labels.select("doc_id", labels.quality.alias("good"))
    got = clean_lines(docs).join(labels, "doc_id").select("quality.base_failed", "quality.kept", "good")
    assert got.filter("good = 1 and not base_failed and not kept").count() == 0
    assert got.filter((F.col("good") == 0) & F.col("kept")).count() == 0


pytestmark = pytest.mark.filterwarnings("ignore")
