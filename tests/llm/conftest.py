from __future__ import annotations

import pytest

TEXTS = {
    "ru": "Компания готовит площадку под строительство школы. Объём выпуска цемента в области составил больше, чем годом ранее.\nСправка\nПартия кирпича забракована — прочность оказалась ниже, «СтройТрест» готовит ответ.",
    "en": "Builders completed more homes than a year before. The price of cement moved by a little in the town.\nInspectors found defects in the river bridge — repairs take days.",
    "de": "Der Preis für Zement stieg in der Stadt. Prüfer fanden Mängel an der Brücke – Größe und Höhe fehlen.",
}


@pytest.fixture(scope="session")
def repairer():
    from feedmill.llm import encoding

    return encoding.Repairer({k: encoding.dictionary([x.encode() for x in v.split("\n")] * 3) for k, v in TEXTS.items()})


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of the shape of ``unified`` with columns whose names the operators use themselves."""

    def make(*texts, source="s", title="t", url=None):
        data = [(n, source, title, t, url or f"https://h.example/{n}", "kept", "kept", "kept") for n, t in enumerate(texts)]
        return spark.createDataFrame(data, "item_no long, source string, title string, content_text string, url string, _ids string, _src string, ids string")

    return make
