"""Problems 1, 2, 4, 6 and 7 on small fixtures and against plain models."""

import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedmill.llm import cleaning, encoding, mainbody, repeats, residue, spelling

LONG = "Компания готовит площадку под строительство школы, объём выпуска цемента в области составил больше, чем годом ранее, сообщили в ведомстве."


def found(df):
    return sorted(tuple(r) for r in df.collect())


def model_of_repeats(texts, share, least):
    keys = [["".join(c for c in line.lower().replace("ß", "ss") if c.isalpha()) for line in t.split("\n")] if t is not None else [] for t in texts]
    count = {k: sum(k in ks for ks in keys) for ks in keys for k in ks if k}
    return sorted((i, n) for i, ks in enumerate(keys) for n, k in enumerate(ks, 1) if k and count[k] >= least and count[k] >= share * len(texts))


@pytest.mark.parametrize("seed", range(4))
def test_repeated_lines_as_a_plain_count_finds_them(spark, rows, seed):
    rng = random.Random(seed)
    pool = ["Все права защищены.", "ВСЕ ПРАВА, защищены!", "> поделиться", "GRÖSSE", "Größe", "12345", "", "a", "б", "в\r", "г " * 400]
    texts = [None if rng.random() < 0.1 else "\n".join(rng.choice(pool if rng.random() < 0.5 else [f"line {rng.random()}"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    df = rows(*texts)
    assert found(repeats.repeated_lines(df)) == model_of_repeats(texts, 0.1, 6)
    cut = {r.item_no: r for r in repeats.without_repeated(df).collect()}
    gone = set(model_of_repeats(texts, 0.1, 6))
    for i, t in enumerate(texts):
        assert cut[i].content_text == (None if t is None else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if (i, n) not in gone))
        assert (cut[i]._ids, cut[i]._src, cut[i].ids) == ("kept",) * 3


def test_blocks_of_several_lines(spark, rows):
    blocks, _ = repeats.repeated_blocks(rows(*["начало\nпервая\nвторая\nтретья" + "абвгдежз"[k] for k in range(8)]))
    assert sorted((r.depth, r.rows) for r in blocks.collect()) == [(1, 8)] * 3 + [(2, 8)] * 2
    # as long as rows go, and each counted once a row
    footer = "\n".join(f"строка {'абвгдежзик'[k]}" for k in range(10))
    blocks, _ = repeats.repeated_blocks(rows(*[f"{'абвгдежз'[k]}\n{footer}\n{footer}" for k in range(8)]))
    assert sorted({(r.depth, r.rows) for r in blocks.collect()}) == [(1, 8), (2, 8), (4, 8), (8, 8), (16, 8)]


@pytest.mark.parametrize("least", [1, 3])
def test_any_number_of_rows_may_be_enough(spark, rows, least):
    df = rows("a\nb", "b\nc", "c\nb", "d")
    assert found(repeats.repeated_lines(df, min_share=0.0, min_rows=least)) == ([(0, 2), (1, 1), (2, 2)] if least == 3 else [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2), (3, 1)])


def test_repeats_of_nothing(spark, rows):
    empty = rows("a").limit(0)
    assert found(repeats.repeated_lines(empty)) == [] and repeats.without_repeated(empty).count() == 0
    nulls = rows(None, None, "x").withColumn("source", F.lit(None).cast("string"))
    assert found(repeats.repeated_lines(nulls)) == []
    assert len(found(repeats.repeated_lines(rows(*["x"] * 6).withColumn("source", F.lit(None).cast("string"))))) == 6


def test_spelling():
    cases = {"ｔｏｎｎｅｓ　a": "tonnes a", "oбзopе": "обзоре", "соntеnt": "content", "й ё": "й ё", "а​б­﻿в": "абв", "a b c d": "a b c d", "№ м² ½ λ µm BIM-модель": "№ м² ½ λ µm BIM-модель", "": "", "а́": "а́"}
    assert {k: spelling.normalise(k) for k in cases} == cases
    assert spelling.normalise(None) is None and spelling.fold("ПРИВЕТ Straße") == "привет strasse"
    assert [spelling.respelt(k) for k in cases] == [True] * 6 + [False] * 3
    assert not spelling.respelt(None) and spelling.respelt("Бłоk")
    long = "слово " * 200_000 + "о" + "o"
    assert spelling.respelt(long) and len(spelling.normalise(long)) == len(long)


@pytest.mark.parametrize("seed", range(3))
def test_spelling_is_stable_and_composed(seed):
    rng = random.Random(seed)
    alphabet = "абвёйіўABcdéöß １ａＡ​ ̆̈oοоcс.-\n"
    for _ in range(300):
        once = spelling.normalise("".join(rng.choice(alphabet) for _ in range(30)))
        assert spelling.normalise(once) == once and unicodedata.normalize("NFC", once) == once and once.count("\n") == spelling.normalise(once).count("\n")


def test_spelling_over_a_table(spark, rows):
    df = rows("а​б", None, "", "ровно", "а​б")
    out = [r.content_text for r in spelling.normalised(df, ["content_text", "title"]).orderBy("item_no").collect()]
    assert out == ["аб", None, "", "ровно", "аб"]
    assert [r.content_text for r in spelling.normalised(df, ["content_text"], folded=True).orderBy("item_no").collect()] == out


CHAINS = [(("utf-8", "cp1251"),), (("utf-8", "latin-1"),), (("cp1251", "latin-1"),), (("koi8-r", "cp1251"),), (("cp1251", "koi8-r"),), (("cp1251", "cp866"),), (("cp866", "cp1251"),), (("utf-8", "latin-1"), ("utf-8", "latin-1"))]


@pytest.mark.parametrize("chain", CHAINS, ids=lambda c: "+".join(f"{a}>{b}" for a, b in c))
def test_garbled_text_comes_back(repairer, chain):
    sound = "Компания готовит площадку под строительство школы, объём выпуска цемента в области больше"
    text = sound
    for right, wrong in chain:
        text = text.encode(right).decode(wrong, "surrogateescape" if wrong != "cp1251" else "strict")
    assert repairer.restore(text) == (sound, True)
    assert repairer.restore(f"{LONG}\n{text}\n\n") == (f"{LONG}\n{sound}\n\n", True)


def test_passages_and_lost_text(repairer):
    assert repairer.restore("Компания готовит площадку вЂ” больше, чем годом ранее") == ("Компания готовит площадку — больше, чем годом ранее", True)
    assert repairer.restore("Der Preis fÃ¼r Zement stieg in der Stadt, PrÃ¼fer fanden MÃ¤ngel") == ("Der Preis für Zement stieg in der Stadt, Prüfer fanden Mängel", True)
    assert repairer.restore("текст � дальше") == ("текст � дальше", True)
    for sound in (LONG, LONG.upper(), "Что это??? Неужели?!", "Größenwerk и Âncora Clã, завод «Ђурђево Њива»", "Шифр «РС-366 СССР» расшифровали", "100 % #нашдвор", "", None, "λ = 5 м²", "?????? ????? ? ?????? ??????? 24,8 %", "67 683 м² жилья"):
        assert repairer.restore(sound) == (sound, False), sound


SOUND = {
    "ru": "Завод «СтройТрест» готовит площадку — партия кирпича забракована, прочность оказалась ниже",
    "de": "Prüfer fanden Mängel an der Brücke – Größe und Höhe fehlen",
    "en": "Inspectors found defects in the river bridge — repairs take days",
}


@pytest.mark.parametrize("language", SOUND)
def test_every_chain_of_readings_comes_back(repairer, language):
    """Each chain of up to three readings that keeps every byte, over a text of each language."""
    sound, tried = SOUND[language], 0
    single = [(r, w) for w, r in encoding.SINGLE] if language == "ru" else []
    steps = [("utf-8", w) for w in encoding.WRONG_FOR_UTF8] + single

    def read(text, right, wrong):
        try:
            out = text.encode(right).decode(wrong)
        except UnicodeError:
            return None
        return out if out.encode(wrong).decode(right) == text else None

    front = [(sound, False)]
    for _ in range(encoding.DEPTH):
        after = []
        for text, was_single in front:
            for right, wrong in steps:
                bad = None if right != "utf-8" and was_single else read(text, right, wrong)
                if bad is not None and bad != sound:
                    after.append((bad, right != "utf-8"))
        front = after[:: max(1, len(after) // 30)]
        for bad, _ in front:
            tried += 1
            assert repairer.restore(bad) == (sound, True), bad
    assert tried > 3


def test_garbled_fields(spark, rows, repairer):
    bad = LONG.encode("cp1251").decode("latin-1")
    df = rows(LONG, bad, None, "", bad, "?" * 100_000)
    assert found(cleaning.garbled_fields(df, repairer).select("item_no", "field_name")) == [(1, "content_text"), (4, "content_text")]
    assert found(cleaning.misspelt_fields(rows("а​б", bad + "​", LONG), repairer)) == [(0, "content_text")]
    assert found(cleaning.garbled_fields(df.limit(0), repairer)) == [] and found(cleaning.misspelt_fields(df.limit(0), repairer)) == []


RESIDUE = ["404\nPage not found", "Lorem ipsum opus tegula via. Pons porta.", "{{ title }}", LONG + " ${news.text} дальше", "{⁠{ti​tle}}", "undefined\nundefined", "Для просмотра a.example включите JavaScript в настройках браузера.", "Ошибка 503. Сервис временно недоступен.", "null", "Seite nicht gefunden", "test test test"]
ARTICLES = [LONG, "Надпись «Страница не найдена» застройщик превратил в рекламный щит у въезда в город, рассказали очевидцы.", "Типография забыла заменить пробный абзац lorem ipsum, тираж 70 805 экземпляров пошёл под нож.", "Множество решений записывают как {a; b}, где a равно 36, а b — 420.", "Скидка 20 % и ещё 30% на всё", None, "", "  \n"]


def test_residue(spark, rows):
    assert [residue.is_residue(t) for t in RESIDUE] == [True] * len(RESIDUE)
    assert [residue.is_residue(t) for t in ARTICLES] == [False] * len(ARTICLES)
    assert found(cleaning.residue_items(rows(*RESIDUE, *ARTICLES, "слово " * 300_000))) == [(i,) for i in range(len(RESIDUE))]
    assert found(cleaning.residue_items(rows("x").limit(0))) == []


def test_no_screen_loses_residue(spark, rows, repairer):
    """What spares texts the closer look lets through whatever that takes for residue, in any guise."""
    guises = [lambda t: t, str.upper, lambda t: t.replace("о", "o").replace("е", "e"), lambda t: "\u200b".join(t), lambda t: f"{t} минстройроссии.com", lambda t: f"«{t[:3]}» {t} — 404", lambda t: f"- {t} -", lambda t: t.replace(" ", "\n")]
    texts = [g(t) for t in [*RESIDUE, *filter(None, ARTICLES), "Ошибка сервера", "Lapis et murus sine porta, novum opus pontis"] for g in guises]
    flags = residue.residue_flags(pa.array(texts))
    assert flags.tolist() == [residue.is_residue(t) for t in texts]
    assert residue.is_residue("Ошибка сервера минстройроссии.com") and not residue.is_residue("Код сайта: запрос, минут 5") and not residue.is_residue("Neue Preise: Zement, Kies, Ziegel, Beton, Holz, Stahl")
    garbled = "Ошибка 404. Страница не найдена, ошибка сервера.".encode().decode("cp1251")
    assert found(cleaning.residue_items(rows(garbled, LONG), repairer)) == [(0,)]


PAGE = ["Главная", "Новости", "Цены и индексы", "", "Мы используем файлы cookie, чтобы сайт работал лучше.", LONG, "Справка", "Битум | 5 073 | +40,6 %", "— цемент: 61 439 руб. за тонну;", "Адрес приёма замечаний: г. Сосноборск, ул. Каменщиков, 3", "Погода: Сосноборск, +24°, ветер 16 м/с", LONG, "Автор: Тихомир Щебнев", "Читайте также", "12:37 Дефицит цемента в Плотинске — 33,1 %", "На ремонт школы в Плотинске направят 3 млрд рублей", "18+", "© Газета, 2020"]
OWN = [6, 7, 8, 9, 10, 12]


def test_main_bodies(spark, rows, repairer):
    assert [n for n, mine in enumerate(mainbody.own_lines(PAGE), 1) if mine] == OWN
    text = "\n".join(PAGE)
    noise = [n for n, line in enumerate(PAGE, 1) if line and n not in OWN]
    df = rows(text, None, "", "Page not found", "Главная\nНовости")
    assert found(cleaning.surrounding_lines(df, repairer)) == [(0, n) for n in noise] + [(4, 1), (4, 2)]
    assert found(cleaning.bodies(df, repairer)) == [(0, "\n".join(PAGE[n - 1] for n in OWN)), (1, None), (2, ""), (3, ""), (4, "")]
    assert found(cleaning.surrounding_lines(df.limit(0), repairer)) == []
    # lines that repeat in their source belong to problem 1; those without letters never do
    many = rows(*[text] * 6)
    assert found(cleaning.surrounding_lines(many, repairer)) == [(i, 17) for i in range(6)]


def test_long_lines_are_read_as_short_ones_are():
    notice = "Мы используем файлы cookie, чтобы сайт работал лучше и быстрее для каждого читателя. "
    assert mainbody.kind(notice * 9) == mainbody.kind(notice) == mainbody.NOISE
    assert mainbody.kind(f"{LONG} " * 9 + notice) == mainbody.kind(LONG) == mainbody.PROSE


def test_pages(spark):
    html = f"<html><head><title>T</title><script>var a='</p>'</script></head><body><nav><a href='/'>Главная</a></nav><div class='x'><h1>T</h1><p>{LONG}<b><br><p>Справка</p><p>{LONG}</div><footer>© Газета, 2020</footer></body></html>"
    assert mainbody.page_body(html) == mainbody.page_body(html, [".x"]) == f"{LONG}\nСправка\n{LONG}"
    assert mainbody.page_body(None) is None and mainbody.page_body("") == "" and mainbody.page_body("<p>", ["a > b", ""]) == ""
    pages = spark.createDataFrame([(1, html, "s"), (2, None, "s"), (3, html, None)], "page_id long, html string, source string")
    sources = spark.createDataFrame([("s", [".x"]), ("s", None)], "name string, content_selectors array<string>")
    out = {r.page_id: r.body for r in mainbody.page_bodies(pages, sources).collect()}
    assert out[1] == out[3] == f"{LONG}\nСправка\n{LONG}" and out[2] is None


def test_dictionaries_are_trained_on_a_bounded_sample(spark):
    rows = [(k, LONG + str(k), "ru") for k in range(50)] + [(99, None, "ru"), (100, "text", None), (101, "", "en")]
    one = encoding.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    assert list(one.dictionaries) == ["ru"] and one.dictionaries == encoding.train(spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string"), per_language=20).dictionaries
