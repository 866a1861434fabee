"""Problem 7: template residue, filler, error pages and script notices instead of an article.

A multi-pattern automaton (Aho-Corasick) holds phrases of several languages. A text is excluded when the phrases cover
most of its letters, whatever its length; an unfilled placeholder anywhere excludes it, too. Everyday words of such
notices count only beside one of the phrases. Texts are matched in one spelling (and, where a repairer is given, decoded
rightly), so invisible characters and look-alikes don't hide a phrase.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from feedmill.llm.spelling import SIGNS, normalise

#: Share of a text's letters that phrases must cover for it to be excluded.
COVERAGE = 0.5

#: What error pages, access checks, script notices, filler and empty values say, in small letters.
PHRASES = """
страница не найдена|страница не существует|страница удалена|страница недоступна|запрашиваемая страница|такой страницы нет|такого материала больше нет|такого материала нет
материал снят с публикации|материал удалён|материал недоступен|материал не найден|материал перемещён|публикация удалена|статья не найдена|статья удалена|новость не найдена|новость удалена|документ не найден
сервис временно недоступен|сайт временно недоступен|сервер временно недоступен|сервер не отвечает|ведутся технические работы|технические работы на сайте|попробуйте позже|попробуйте обновить страницу|повторите попытку позже
внутренняя ошибка сервера|ошибка сервера|ошибка базы данных|ошибка запроса к базе данных|ошибка запроса|ошибка загрузки|произошла ошибка|что-то пошло не так|ошибка доступа
доступ ограничен|доступ запрещён|доступ закрыт|доступ заблокирован|нет доступа|недостаточно прав|требуется авторизация|войдите чтобы продолжить
слишком много запросов с вашего адреса|слишком много запросов|подтвердите что запросы отправляли вы|подтвердите что вы не робот|проверяем что вы не робот|я не робот|введите символы с картинки|проверка браузера|обнаружена подозрительная активность
вернуться на главную страницу|вернуться на главную|перейти на главную|назад на главную|на главную
javascript отключён|javascript отключен|включите javascript в настройках браузера|включите javascript|включите поддержку javascript|для работы сайта необходим javascript|не может показать материал|необходимо включить сценарии|ваш браузер не поддерживает выполнение сценариев|ваш браузер не поддерживает javascript|ваш браузер не поддерживает|ваш браузер устарел|обновите его и повторите попытку|обновите браузер
page not found|file not found|not found|the page you requested|does not exist|no longer available|has been removed|internal server error|bad gateway|gateway timeout|service unavailable|service temporarily unavailable|temporarily unavailable|access denied|access restricted|forbidden|unauthorized|too many requests|bad request|request timeout|error code|an error occurred|something went wrong|server error|database error|error establishing a database connection|please try again later|try again later
you need to turn on javascript to run this app|you need to enable javascript to run this app|please enable scripts and reload this page|please enable javascript|please enable scripts|enable javascript|enable cookies|reload this page|javascript is disabled|javascript is required|requires javascript|your browser does not support|checking your browser before opening|checking your browser before accessing|checking your browser|checking if the site connection is secure|verify you are human|verifying you are human|are you a robot|complete the captcha|ray id|unusual traffic
fatal error|parse error|undefined index|undefined variable|undefined offset|uncaught exception|stack trace|template body is missing|template not found|call to undefined function|null pointer|segmentation fault|traceback
undefined|null|nan|none|nil|array|object object|true|false|n/a|описание отсутствует|текст отсутствует|нет описания|нет данных|без описания|нет текста
seite nicht gefunden|die seite existiert nicht|interner serverfehler|serverfehler|zugriff verweigert|zugriff beschränkt|dienst nicht verfügbar|vorübergehend nicht verfügbar|zu viele anfragen|bitte aktivieren sie javascript|javascript ist deaktiviert|ihr browser unterstützt|bitte später erneut versuchen|beitrag wurde entfernt|zur startseite
старонка не знойдзена|унутраная памылка сервера|доступ абмежаваны|памылка сервера|уключыце javascript|сэрвіс часова недаступны|вярнуцца на галоўную|занадта шмат запытаў|матэрыял зняты з публікацыі
здесь будет текст новости|здесь будет текст статьи|здесь будет текст|здесь будет|введите текст анонса|введите текст|введите заголовок|рыба-текст для проверки вёрстки не публиковать|рыба-текст|рыбный текст|текст-рыба|для проверки вёрстки|текст-заполнитель|замените его перед публикацией|текст анонса|текст новости|абзац текста|образец текста|пример текста|тестовая новость|тестовый текст|тестовая статья|тест тест тест|проверка связи|это тест|фыва|йцукен|олдж|asdf|qwerty
placeholder text|sample text|your text here|insert text here|text goes here|content goes here|headline goes here|test article|dummy text|test test|blah blah|hier steht ihr text|blindtext|platzhaltertext|beispieltext|тут будзе тэкст|тэкст навіны
"""
#: Everyday words that such notices hold beside the phrases above.
BESIDE = """
ошибка|таблица|недоступна|подождите|минут|минуту|минуты|запрос|номер запроса|код|сайт|веб-узел|web-узел|для просмотра|повторите попытку|не публиковать|заголовок|проверка|памылка
error|warning|notice|on line|in line|ray|test|fehler
"""
#: What no text of some length in the languages of Latin letters does without.
FUNCTION_WORDS = """
the of and to in a is for on that with at by from are was be as an it this
der die das und in zu den von mit ist im des auf für eine ein sich dem nicht bei nach
"""
#: Endings of Latin words (fixed values), the share of a text's letters that such words take in filler, and the words it has.
LATIN_ENDING = re.compile(r"[a-z]*(?:us|um|is|es|as|os|em|am|ae|im|it|at|et|nt|ur|or|men|ens|ons|ex|ix|ec|ut|[aeio])|ab|ad|id|ac|est|sed|non|per|sub|nostrud|aliquip|adipiscing")
LATIN_SHARE, LATIN_WORDS = 0.9, 6

#: An unfilled placeholder: a name between the signs of a template language.
_NAME = r"[A-Za-z_][\w.\-]*"
PLACEHOLDER = re.compile(
    rf"\{{\{{[\s#/&>^]*{_NAME}(?:\s*\|[^}}\n]*)?\s*\}}\}}|\{{%-?\s*[a-z]+\b[^%\n]*%\}}|<%[=\-#]?\s*{_NAME}[^%\n]*%>|\$\{{\s*{_NAME}\s*\}}|\{{\$\s*{_NAME}\s*\}}"
    rf"|\[\[\s*{_NAME}\s*\]\]|@@\s*{_NAME}\s*@@|(?<![\w%])%{_NAME}%(?![\w%])|(?<![\w#&])#{_NAME}#(?!\w)|<\?(?:php|=)[^?\n]*\?>|\[%\s*{_NAME}\s*%\]|(?<!\w)__[A-Z][A-Z_]*__(?!\w)"
)
#: The signs alone, for a filter over a whole batch.
PLACEHOLDER_SIGNS = r"\{\{|\{%|<%|<\?|\$\{|\{\$|\[\[|\[%|@@|%[A-Za-z_]|#[A-Za-z_]|__[A-Z]"

_WORD = re.compile(r"[^\W\d_]+")
_NAMES = re.compile(r"«[^»\n]*»|“[^”\n]*”|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}\b|\b[0-9a-f]*\d[0-9a-f]*\b")
_GAP = re.compile(r"[^\w\n/-]+")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, sure in ((BESIDE, False), (PHRASES, True)):
        for phrase in phrases.replace("\n", "|").split("|"):
            if phrase := _squeeze(phrase):
                found.add_word(f" {phrase} ", (len(phrase), sure))
    found.make_automaton()
    return found


def _squeeze(text: str) -> str:
    """Small letters, one space for anything between words."""
    return _GAP.sub(" ", text.replace("\n", " ").lower()).strip(" -/")


AUTOMATON = None


def coverage(text: str) -> float:
    """The share of the letters of ``text`` (names in quotes, hosts and numbers aside) that lie in phrases.

    Words that count only beside a phrase count for nothing without one. No phrase goes on beyond a name.
    """
    global AUTOMATON
    AUTOMATON = AUTOMATON or _automaton()
    plain = " " + _squeeze(_NAMES.sub(" 0 ", text)) + " "
    total = sum(map(len, _WORD.findall(plain)))
    matches = list(AUTOMATON.iter(plain)) if total else []
    if not any(sure for _, (_, sure) in matches):
        return 0.0
    covered = bytearray(len(plain))
    for end, (size, _) in matches:
        covered[end - size : end] = b"\1" * size
    return sum(len(m[0]) for m in _WORD.finditer(plain) if covered[m.start()]) / total


def is_latin(text: str) -> bool:
    """Whether a text is Latin filler: nearly all of its words end as Latin ones do, and none is what a text of a living
    language has."""
    words = _WORD.findall(text.lower())
    if len(words) < LATIN_WORDS or not _FUNCTION_WORDS.isdisjoint(words):
        return False
    return sum(len(w) for w in words if LATIN_ENDING.fullmatch(w)) >= LATIN_SHARE * sum(map(len, words))


_FUNCTION_WORDS = set(FUNCTION_WORDS.split())
_LIVING = rf"(?:^|[^\pL])(?:{'|'.join(sorted(_FUNCTION_WORDS))})(?:[^\pL]|$)"


def _holds(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, pattern), False).to_numpy(zero_copy_only=False)


def suspects(texts: pa.Array) -> np.ndarray:
    """Which texts hold a phrase that counts, or may be Latin: the only ones that ``coverage`` and ``is_latin`` can take for
    residue. Null and blank texts are none.

    Every text goes through the automaton, its words one space apart, with all its names: these take phrases away only.
    """
    global AUTOMATON
    AUTOMATON = AUTOMATON or _automaton()
    small = pc.utf8_lower(pc.fill_null(texts, ""))
    # Latin: letters a to z nearly alone, and no word of a living language
    plain = pc.utf8_length(pc.replace_substring_regex(small, "[^a-z]+", "")).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(plain)
    letters = pc.utf8_length(pc.replace_substring_regex(small.take(pa.array(some)), r"[^\pL]+", "")).to_numpy(zero_copy_only=False)
    some = some[plain[some] >= LATIN_SHARE * letters - 1e-9]
    out = np.zeros(len(texts), bool)
    out[some] = ~_holds(small.take(pa.array(some)), _LIVING)
    squeezed = pc.replace_substring_regex(small, r"[^\pL\pN_/-]+", " ").to_pylist()
    for i, text in enumerate(squeezed):
        out[i] = out[i] or any(sure for _, (_, sure) in AUTOMATON.iter(f" {text.strip(' -/')} "))
    return out


def is_residue(text: str | None, limit: float = COVERAGE) -> bool:
    """Whether a text is residue instead of an article. Null and blank texts are not."""
    if not text or not text.strip():
        return False
    text = normalise(text)
    return PLACEHOLDER.search(text) is not None or coverage(text) >= limit or is_latin(text)


def residue_flags(texts: pa.Array, limit: float = COVERAGE) -> np.ndarray:
    """``is_residue`` of each text of a batch; texts that hold neither a phrase nor a placeholder are spared the closer look."""
    odd = np.flatnonzero(_holds(texts, SIGNS))
    if len(odd):
        spelt = texts.to_pylist()
        for i in odd:
            spelt[i] = normalise(spelt[i])
        texts = pa.array(spelt, pa.string())
    out = np.zeros(len(texts), bool)
    for i in np.flatnonzero(suspects(texts) | _holds(texts, PLACEHOLDER_SIGNS)):
        out[i] = is_residue(texts[i].as_py(), limit)
    return out
