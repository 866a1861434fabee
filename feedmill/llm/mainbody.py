"""Problem 2: keep the main body of a page and drop what stands around it.

Line-block distribution: the lengths of the text that reads as an article are summed over sliding windows of lines; the
text between the surge and the dive is the body. Lines inside it that are notices, bylines, counters, teasers and the
like are told by what they say (phrases of several languages) and by their shape, and go, too. Subheads, lists, figures
and addresses inside the body stay.
"""

from __future__ import annotations

import html as html_module
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.html import Page, title_of
from feedmill.llm.spelling import normalise

#: Share of a line's characters that sentences with a phrase must make up for it to be no article text.
NOISE_SHARE = 0.25
#: Lines a window spans, and the characters of article text in it from which a body begins or ends.
WINDOW, SURGE = 3, 40

PROSE, LIST, SHORT, NOISE, BLANK, HEAD = range(6)

#: Menu entries of news sites, in small letters.
MENU = """
главная|новости|статьи|стройка|нормативы|цены|цены и индексы|тендеры|интервью|фотогалерея|галерея|видео|фото|о редакции|о нас|о проекте|о компании|контакты|вакансии|архив|архив номеров|подписка|реклама|рекламодателям|мнения|аналитика|обзоры|события|календарь|справочник|форум|блоги|спецпроекты|рубрики|темы|карта сайта|поиск|войти|регистрация|rss|обратная связь|правила|лента|авторы|журнал|документы
home|news|articles|prices|tenders|interviews|interview|gallery|photos|video|about|about us|contact|contacts|contact us|archive|subscribe|subscription|jobs|careers|codes|standards|building|construction|opinion|analysis|events|calendar|directory|forum|blog|topics|sections|search|login|log in|sign in|register|rss|authors|magazine|documents|site map|sitemap|advertise|terms|privacy|markets|reviews
start|startseite|vergaben|nachrichten|artikel|bau|baustellen|normen|preise|ausschreibungen|interviews|galerie|bilder|fotos|videos|über uns|kontakt|archiv|abo|abonnement|stellen|karriere|meinung|analyse|termine|themen|suche|anmelden|registrieren|impressum|datenschutz|anzeigen|agb|zeitschrift
галоўная|навіны|артыкулы|будоўля|нормы|цэны|тэндары|інтэрв'ю|інтэрв’ю|фотагалерэя|пра рэдакцыю|пра нас|кантакты|вакансіі|архіў|падпіска|рэклама|карта сайта|зваротная сувязь|пошук
"""
#: Headings above links to other articles.
RELATED = """
самое читаемое|ещё по теме|популярное за неделю|популярное|сейчас обсуждают|выбор редакции|лента дня|похожие материалы|читайте также|читайте по теме|материалы по теме|по теме|другие новости|главное за день|рекомендуем|рекомендуемые материалы|последние новости|новости партнёров|ещё новости|вам может быть интересно|самое популярное|самое обсуждаемое|смотрите также|похожие новости
most read|read next|up next|most viewed|most popular|most discussed|read also|read more|related|related articles|related stories|related news|more on this|more on this topic|more news|more stories|popular|popular this week|trending|trending now|editor picks|editors' picks|editor's picks|latest news|latest|top stories|recommended|recommended for you|you may also like|see also|today's feed|today|being discussed
meistgelesen|auch lesenswert|ebenfalls lesenswert|lesen sie auch|mehr zum thema|weitere meldungen|weitere artikel|weitere nachrichten|ähnliche artikel|beliebt|beliebt diese woche|empfehlungen|empfehlung der redaktion|tipp der redaktion|auswahl der redaktion|aktuelle meldungen|meist diskutiert|das könnte sie auch interessieren|siehe auch|heute
самае чытанае|яшчэ па тэме|чытайце таксама|папулярнае за тыдзень|папулярнае|выбар рэдакцыі|стужка дня|падобныя матэрыялы|зараз абмяркоўваюць|іншыя навіны
"""
#: Parts of lines that stand around an article, in small letters. "^" is the line's beginning, marks aside.
NOISE = """
cookie|куки |куки.|приватност|персональных данных|обработки данных|обработку данных|данные браузера|даёте согласие|вы соглашаетесь|datenschutz|einwilligung|приватнасц|персанальных да|вы згаджаецеся|апрацоўкай даных|апрацоўку даных|you agree to|you consent|stimmen sie der|erklären sie sich
все права|права защищены|перепечатк|при цитировании|при копировании|копирование без|активной ссылк|ссылка на источник|указание источника|публичной офертой|справочный характер|мнение автора|мнение авторов|с позицией редакции|all rights reserved|reuse only|for general information|views of the author|not be reproduced|reprint|alle rechte|nachdruck|keine gewähr|перадрук|усе правы|са спасылкай на крыніц
понравилась статья|понравился материал|понравилась новость|расскажите коллегам|расскажите друзьям|поделиться материалом|поделиться новостью|поделиться с друзьями|поделитесь|^поделиться|оцените публикацию|оцените статью|оцените материал|отправить заметку|сохранить в закладки|в закладки|подпишитесь|подписывайтесь|рассылк|получайте сводку|следите за нами|мы в соцсетях|share this|share with|share on|tell a friend|tell a colleague|forward this|pass it on|send this|like this story|like this article|rate this|subscribe|newsletter|digest every|digest each|follow us|sign up|beitrag gefällt|leiten sie ihn|artikel teilen|beitrag teilen|abonnieren|bewerten sie|weitersagen|падзяліцеся|падпішыцеся|раскажыце калегам|ацаніце
^автор:|^авторы:|автор:|^текст:|текст подготовил|редактор выпуска|собственный корреспондент|^фото:|, отдел новостей|^источник:|^reported by|reported by|written by|edited by|staff writer|redaktion bauwesen|, redaktion|^autor:|^autorin:|^text:|^аўтар:|^тэкст:|уласны карэспандэнт|рэдактар выпуску|тэкст падрыхтава
^комментарии|^комментариев|комментарии (|просмотров:|просмотры:|прочитали:|войти |^регистрация|следующая новость|предыдущая новость|^печать|версия для печати|поиск по сайту|показать ещё|загрузить ещё|^реклама|на правах рекламы|^рубрика:|^рубрики:|^теги:|; теги:|^тег:|^погода:|^курс валют|^курс цб|^курсы |наверх ↑|^наверх|к началу страницы|мобильная версия|создание сайта|карта сайта|обратная связь|пользовательское соглашение|почта редакции|телефон редакции|^редакция:|сетевое издание|свидетельство о регистрации|^©|© 20|оставить комментарий|написать комментарий
^comments|comments (|^views:|views: |log in|next story|next article|previous story|previous article|^print|search the site|search this site|show more|load more|^advert|sponsored|^section:|^tags:|; tags:|^topics:|^weather:|back to top|mobile version|site map|sitemap|newsroom:|terms of use|privacy|web design by|site by
^kommentare|kommentare (|^aufrufe|aufrufe:|anmelden|nächster artikel|nächster beitrag|nächste meldung|^drucken|suche auf|mehr anzeigen|^anzeige|^rubrik:|^schlagworte:|; schlagworte:|^wetter:|nach oben|mobile ansicht|impressum|^redaktion:
^каментары|каментарыі (|праглядаў:|^прагляды|^увайсці|наступная навіна|^друк|пошук па сайце|паказаць яшчэ|^рэклама|^рубрыка:|^надвор|^уверх|мабільная версія|зваротная сувязь|^рэдакцыя:|пошта рэдакцыі
"""
_menu = {x for line in MENU.strip().split("\n") for x in line.split("|")}
_related = {x for line in RELATED.strip().split("\n") for x in line.split("|")}
_MENU_WORDS = {w for x in _menu for w in re.findall(r"\w+", x)}



def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for part in NOISE.strip().replace("\n", "|").split("|"):
        found.add_word(("\n" + part[1:]) if part[0] == "^" else part, 1)
    found.make_automaton()
    return found


AUTOMATON = None
_SENTENCE = re.compile(r"(?<=\w{3}[.!?…])\s+")  # after a word, not an abbreviation
_MARKS = re.compile(r"^[\s>•*—–·#\"-]+")
_LIST = re.compile(r"^\s*(?:[—–•*·▪◦‣-]\s|\(?\d{1,4}[).]\s|[а-яa-z]\)\s)|;\s*$|^[^|]+(?:\s\|\s[^|]*\d[^|]*)+$|\d[^/]*\s/\s[^/]*\d", re.IGNORECASE)
_DECOR = re.compile(r"^\s*[>•*—–·#-]+\s+|\s*…\s*$")
_ADDRESS = re.compile(r"(?:\bг\.|\bул\.|\bпр\.|\bпл\.|\bвул\.|\bstr\.)\s*[^\s,]+|\bадрес|^anschrift|^address|straße \d+\b|\b\d+[a-z]? [A-Z]\w+ (?:street|road|lane|avenue)\b", re.IGNORECASE)
_NO_WORDS = re.compile(r"\W*\d{1,2}\s?\+\W*|[\W\d]*[↑→←↓©][\W\d]*")
_INNER_END = re.compile(r"[а-яёіўa-zäöüß)»%][.!?] [«„“А-ЯЁІA-ZÄÖÜ]")
_END = re.compile(r"[.!?:][»”“\"’)]*\s*$")
_SEPARATORS = re.compile(r"\s*(?:[|·•/→»›>]|\s-\s|\s{2,})\s*")
_TIMED = re.compile(r"^\s*\d{1,2}[:.]\d{2}\s|\s\(\d+\)\s*$")
_WORDS = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*")


def _plain(line: str) -> str:
    return " ".join(_DECOR.sub("", _DECOR.sub("", line)).lower().split()).rstrip(" .…:")


def _says(text: str) -> bool:
    return next(AUTOMATON.iter("\n" + _MARKS.sub("", text)), None) is not None


def is_noise(line: str) -> bool:
    """Whether a line says what stands around an article: whether the sentences that do are a fair share of it. ``line``
    has single spaces between words and may be of any length."""
    global AUTOMATON
    AUTOMATON = AUTOMATON or _automaton()
    line = line.lower()
    if not _says(line):
        return False
    sentences = _SENTENCE.split(line)
    return len(sentences) == 1 or sum(len(x) for x in sentences if _says(x)) >= NOISE_SHARE * len(line)


_KNOWN: dict[str, int] = {}
#: Characters of a line up to which its kind is kept for the next one like it.
KEPT = 260


def kind(line: str) -> int:
    """What a line reads as: prose, a list item or figure, a heading of links, another short line, or noise."""
    if len(line) > KEPT:
        return _kind(" ".join(line.split()))
    if (found := _KNOWN.get(line)) is None:
        if len(_KNOWN) > 50_000:
            _KNOWN.clear()
        found = _KNOWN[line] = _kind(" ".join(line.split()))
    return found


def _kind(line: str) -> int:
    size = len(line)
    if is_noise(line):
        return NOISE
    if size > 130 and _END.search(line):
        return PROSE
    words = _WORDS.findall(line)
    if not words:
        return BLANK if not line else NOISE if _NO_WORDS.fullmatch(line) else LIST if any(map(str.isdigit, line)) else NOISE
    plain = _plain(line)
    if plain in _related:
        return HEAD
    if plain in _menu:
        return NOISE
    parts = [p for p in (_plain(x) for x in _SEPARATORS.split(line)) if p]
    if parts and sum(p in _menu for p in parts) >= max(1, len(parts) / 2):
        return NOISE
    if size < 140 and len(words) >= 2 and all(w.lower() in _MENU_WORDS for w in words):
        return NOISE
    if _LIST.search(line) or size < 140 and _ADDRESS.search(line):
        return LIST
    if _END.search(line) and len(words) >= 4 or _INNER_END.search(line):
        return PROSE
    # a sentence that was cut off: headings have no clauses
    return PROSE if size > 130 or size > 45 and ", " in line and not _TIMED.search(line) else SHORT


def body(weights: list[int]) -> tuple[int, int]:
    """First and last line of the body, by the surge and the dive of the summed weights; (0, -1) where there is none."""
    n = len(weights)
    first = last = -1
    total = sum(weights[:WINDOW])
    for i in range(n):
        if total >= SURGE and weights[i]:
            if first < 0:
                first = i
        if weights[i] and sum(weights[max(0, i - WINDOW + 1) : i + 1]) >= SURGE:
            last = i
        total += (weights[i + WINDOW] if i + WINDOW < n else 0) - weights[i]
    return (first, last) if first >= 0 and last >= first else (0, -1)


def own_lines(lines: list[str]) -> list[bool]:
    """For each line of a text (in one spelling, decoded rightly) whether it is the article's own. Blank lines are not."""
    kinds = [kind(x) for x in lines]
    weights = [len(x) if k == PROSE else max(SURGE, len(x)) if k == LIST else 0 for x, k in zip(lines, kinds)]
    first, last = body(weights)
    own = [False] * len(lines)
    linked = False  # below a heading of links
    seen = False  # a line of the body stands above
    for i, (line, k) in enumerate(zip(lines, kinds)):
        if k == BLANK or k == NOISE:
            continue
        if k == HEAD:
            linked = True
            continue
        if k in (PROSE, LIST):
            timed = bool(_TIMED.search(line)) and k == PROSE and len(line) < 140
            if first <= i <= last and not timed:
                own[i] = seen = True
                linked = False
            continue
        words = _WORDS.findall(line)
        if linked or len(words) > 4 or len(line) > 45 or any(map(str.isdigit, line)):
            continue
        # a subhead: short, without figures or links above it, after the body's first line or right before it
        near = next((j for j in range(i + 1, len(lines)) if kinds[j] != BLANK), -1)
        if seen or near == first and first >= 0:
            own[i] = True
    return own


_COMMENT = re.compile(r"<!--.*?-->|<(script|style|noscript|template|head)\b.*?</\1\s*>|<!doctype[^>]*>", re.IGNORECASE | re.DOTALL)
_BLOCK = re.compile(r"</?(?:p|div|li|ul|ol|br|h[1-6]|tr|table|td|th|section|article|aside|footer|header|nav|main|body|html|blockquote|figure|figcaption|dl|dt|dd|hr|pre|form|title)\b[^>]*>", re.IGNORECASE)
_TAG = re.compile(r"<[^>]+>")
_ANCHOR = re.compile(r"<a\b[^>]*>(.*?)</a\s*>", re.IGNORECASE | re.DOTALL)


def markup_lines(html: str) -> list[tuple[str, float]]:
    """The lines of a page's text without markup, each with the share of its characters that are links."""
    out = []
    for piece in _BLOCK.split(_COMMENT.sub("", html)):
        linked = sum(len(_TAG.sub("", m)) for m in _ANCHOR.findall(piece))
        text = " ".join(html_module.unescape(_TAG.sub("", piece)).split())
        if text:
            out.append((text, min(1.0, linked / len(text))))
    return out


def page_body(html: str | None, selectors: list[str] | None = None) -> str | None:
    """The own lines of a page. Where one of the selectors names a container with text, only its lines count.

    A null page gives null; a page without a body gives the empty text. Lines that are mostly links, and the page's title,
    are not the article's own.
    """
    if html is None:
        return None
    lines = [(normalise(t), share) for t, share in markup_lines(html)]
    page = Page(html)
    held = next((text for s in selectors or [] if s for i in page.select(s) if len(text := " ".join(page.read(i, " ").split())) >= SURGE), None)
    squeezed = None if held is None else "".join(normalise(held).split())
    title = "".join(normalise(title_of(page) or "").split())
    texts = []
    for t, share in lines:
        bare = "".join(t.split())
        texts.append("" if share >= 0.5 or bare == title or squeezed is not None and bare not in squeezed else t)
    return "\n".join(t for t, keep in zip(texts, own_lines(texts)) if keep)


def page_bodies(pages: DataFrame, sources: DataFrame, html: str = "html", source: str = "source", key: str = "page_id") -> DataFrame:
    """(key, body) of landed pages, with the selectors of their source's catalogue entry (a table of fixed size).

    Pages of unknown sources and sources without selectors are read by line-block distribution alone.
    """
    known = sources.where(F.col("name").isNotNull()).groupBy(F.col("name").alias("_name")).agg(F.first("content_selectors", ignorenulls=True).alias("_selectors"))
    rows = pages.select(F.col(key).alias("_key"), F.col(html).alias("_html"), F.col(source).alias("_name")).join(F.broadcast(known), "_name", "left")

    @F.udf("string", useArrow=True)
    def read(markup, selectors):
        return page_body(markup, list(selectors) if selectors is not None else None)

    return rows.select(F.col("_key").alias(key), read("_html", "_selectors").alias("body"))
