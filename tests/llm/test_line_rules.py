import re
from collections import Counter

from ebbline.llm import line_rules
from tests.llm import edge


def plain_base(text):
    text = text or ""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    words = word.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if word.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_base_figures(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for text in [*texts, *[d[1] for d in edge.DOCS], "a b c a b c", "a\na\n\n\na", "x x x x"]:
        found = line_rules.judge(text.encode() if text is not None else None)
        assert found[:5] == plain_base(text)
        n, repeats = found[0], found[4]
        assert found[5] == (n < 50 or 100 * repeats > 50 * n)


def test_lines():
    fails = lambda line: line_rules.line_fails(line.encode(), line.encode().split())
    assert fails("A plain sentence, with a comma and a full stop.") is None
    assert fails("Öffentlich, über die Straße; schön!") is None
    assert fails("OF!! THE!! AND!! MORE!!") == "punctuation"
    assert fails("word### word&&& word***") == "punctuation"
    assert fails("Home | About | Contact | Blog") == "navigation"
    assert fails("Home About Contact") == "navigation"
    assert fails("Licensed under the Apache License, Version 2.0.") == "boilerplate"
    assert fails("We use cookies to make this site better for you.") == "boilerplate"
    assert fails("He was licensed under a strict law and drove home.") is None


def test_notices_open_a_line_in_any_script():
    fails = lambda line: line_rules.line_fails(line.encode(), line.encode().split())
    for line in (
        "Наша компания © 2020 выпустила новую книгу о море и ветре.", "我们的 privacy policy 在这里有说明，请大家仔细阅读。",
        "Η εταιρεία copyright μας έγραψε ένα νέο βιβλίο για τη θάλασσα.", "Élan © vital et autres textes de la même main.", "２０ © words after a digit of another script.",
    ):
        assert fails(line) is None, line
    for line in ("© 2020 Наша компания", "«— Copyright 2020", "…privacy policy of the site", "Весь текст: all rights reserved。", "COPYRIGHT Élan 2021"):
        assert fails(line) == "boilerplate", line
    assert fails("copyrighted works are many in this long line of words") is None
    for line in ("Startseite Kontakt Impressum", "Accueil Contact Panier", "Inicio Buscar Carrito", "Menü Suche Hilfe"):
        assert fails(line) == "navigation", line


def test_a_text_that_loses_too_much_goes():
    good = "Sentence{0} with{0} some{0} quite{0} different{0} words{0}, number {0}.\n"
    bad = "alpha{0} | beta{0} | gamma{0} | delta{0} | epsilon{0} | zeta{0}\n"
    kept = line_rules.judge("".join(good.format(i) for i in range(9)).encode() + b"Home | About | Contact | Blog")
    assert kept[6] and kept[8] == 1 and b"Home" not in kept[9] and kept[9].startswith(b"Sentence0")
    lost = line_rules.judge("".join(good.format(i) + bad.format(i) + bad.format(i + 100) for i in range(9)).encode())
    assert not lost[5] and not lost[6]


def test_edge_rows(spark):
    found = line_rules.clean(edge.clashing(spark))
    rows = found.collect()
    assert len(rows) == len(edge.DOCS) and not any(r.kept for r in rows)
    assert len(set(found.columns)) == len(found.columns) and "component_id" in found.columns
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].text is None and by_id[2].n_words == 0 and by_id[2].clean_text == ""
    assert by_id[5].text == edge.LONG and by_id[5].n_words == 20_000 == by_id[5].n_repeat_words
    assert by_id[7].clean_text == by_id[7].text
    assert line_rules.clean(edge.empty(spark)).count() == 0
