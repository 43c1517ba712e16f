"""Field rules as plain per-row Python: the yardstick of the rule tests and of the style comparison."""

from __future__ import annotations

import calendar
import re
from datetime import date

from docketry.functions import fixed_values as V


def token_after(text, keywords, cut=None):
    for keyword in keywords:
        at = text.find(keyword)
        if at < 0:
            continue
        window = text[at : at + 25]
        if cut and cut in window:
            window = window[: window.index(cut)]
        for token in window.split(" "):
            if re.search("[0-9]", token):
                return token
    return None


def made_up(token):
    if token is None:
        return False
    rising = any(c in "0123456789" for c in re.findall("[0-9]{4}", token))
    return bool(re.fullmatch("[0-9]", token) or re.search(r"([1-9]+)\1\1\1+", token) or rising)


def amount(text):
    def top(pattern):
        found = []
        for m in re.findall(pattern, text):
            try:
                found.append(float(m.replace("$", "").replace(",", "")))
            except ValueError:
                pass
        return max(found, default=None)

    return top(V.DOLLAR_AMOUNT) if re.search(V.DOLLAR_AMOUNT, text) else top(V.BARE_AMOUNT)


def bad_address(text):
    """Whether an address, or a postal code standing alone, lacks the road and province that belong to it.

    A code is judged by the 80 characters up to its end and the five after it; one that stands too near to
    the start or the end of the text for that, by everything before its end and one character more.
    """
    text = text.replace("email address", " ")

    def placed(part):
        return any(r in part for r in V.ROAD_WORDS) and any(p in part for p in V.PROVINCE_WORDS)

    for found in re.finditer("address", text):
        window = text[found.start() :][:80]
        if not (re.search(V.POSTAL_IN_WINDOW, window) and placed(window)):
            return True
    for code in re.finditer(V.POSTAL_STANDALONE, text):
        before, after = text[: code.end()], text[code.end() :]
        roomy = len(before) > 80 and len(after) > 5
        if not placed(before[-80:] + after[:5] if roomy else before + after[:1]):
            return True
    return False


MONTHS = {name.lower(): n for n, name in enumerate(calendar.month_abbr)}


def dates(text):
    """Every layout says what its three parts are; the day, in one or two digits, must be one that its month has in that year."""
    out = set()
    for (pattern, _), order in zip(V.DATE_FORMATS, ("bdY", "dbY", "mdY", "Ymd", "dbY")):
        for found in re.finditer(pattern.replace("(?U)", ""), text):
            part = dict(zip(order, re.findall(r"\w+", found.group())))
            if len(part) < 3 or len(part["d"]) > 2:
                continue
            month = MONTHS.get(part["b"].lower(), 0) if "b" in part else int(part["m"])
            year = int(part["Y"]) + (2000 if len(part["Y"]) == 2 else 0)
            if year and 1 <= month <= 12 and 1 <= int(part["d"]) <= calendar.monthrange(year, month)[1]:
                out.add(date(year, month, int(part["d"])))
    return sorted(out)


def phone_in(text):
    found = re.search(V.PHONE_PATTERN, text)
    return re.sub(r"[^\w\s]| ", "", found.group()) if found else None


def fax_in(text):
    for keyword in V.FAX_KEYWORDS:
        at = text.find(keyword)
        if at >= 0:
            found = phone_in(text[at : at + 30] if at + 30 < len(text) else text[at : len(text) - 1])
            if found:
                return found
    return None


def email_in(text):
    found = re.search(r"([A-Za-z0-9]+[-_])*[A-Za-z0-9]+@[A-Za-z0-9-\s]+(\.\s*[A-Z|a-z]{2,})+", text)
    return found.group() if found else None


def paid_by_cash(text):
    hits = sum(w in text for w in V.PAYMENT_WORDS)
    return "cash" in text and text.find("cash") != text.find("cashier") and hits < 2
