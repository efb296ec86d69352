"""Web pages as a row of tags and stretches of text, with what each stretch stands in."""

import html
import re
from dataclasses import dataclass

# Elements by what a page author uses them for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript object script select style svg template textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that a closing tag of smaller ones does not reach over.
HOLDERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header html main menu nav ol search "
    "section table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag ends when it is open within the same holder.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements and roles beside the main text.
ASIDE = frozenset("aside button dialog fieldset footer form header label menu nav search".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class and id that name what stands beside the main text.
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "promoted promotion related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)
#: Where comments and adverts name themselves, an article in them is still one of them.
KEPT_SHUT = frozenset("aside comment comments disqus related replies respond sidebar widget widgets ad ads advert sponsored".split())

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:-->|\Z))"
    r"|<(?:[!?])[^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]*))?(?=[\s/>\"']|\Z)", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass(slots=True)
class Piece:
    """A tag (its name, `text` None) or a stretch of text with its innermost block, and whether it is in a link, shut out, or in the marked article."""

    name: str
    text: str | None
    link: bool = False
    shut: bool = False
    marked: bool = False


def attributes(rest: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(rest)} if "=" in rest or "hidden" in rest.lower() else {}


def _beside(name: str, own: dict[str, str]) -> str:
    """Why an element stands beside the main text: hard, named (by class or id), firm (a name that also shuts articles in it), or nothing."""
    role = own.get("role", "").lower()
    hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower()
    if name in ASIDE or role in ASIDE_ROLES or hidden:
        return "firm" if name == "aside" or hidden else "hard"
    if name in ("html", "body", "main") or not own:
        return ""
    words = {w.lower() for w in _NAMES.findall(own.get("class", "") + " " + own.get("id", ""))}
    if name == "article":
        return "firm" if words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo"} else ""
    if words & KEPT_SHUT:
        return "firm"
    return "named" if words & ASIDE_NAMES else ""


def pieces(page: str) -> list[Piece]:
    """The tags and text stretches of a page in order; scripts, styles and other raw content are left out.

    Text that stands in an element beside the main text is `shut`. `marked` tells what the
    page's own markup names its article (`article`, `main`, or the like).
    """
    out: list[Piece] = []
    open_: list[tuple[str, str, bool]] = []  # name, why shut, marks the article
    at, links, shuts, marks = 0, 0, 0, 0
    block = "body"

    def text(a: int, b: int) -> None:
        if a < b:
            out.append(Piece(block, page[a:b], links > 0, shuts > 0, marks > 0))

    def leave() -> None:
        nonlocal links, shuts, marks, block
        name, why, marking = open_.pop()
        links -= name == "a"
        shuts -= bool(why)
        marks -= marking
        block = next((n for n, _, _ in reversed(open_) if n in BLOCKS), "body") if name in BLOCKS else block

    def close(names: set[str], reach: bool) -> None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                while len(open_) > k:
                    leave()
                return
            if not reach and open_[k][0] in HOLDERS:
                return

    while found := _TAG.search(page, at):
        text(at, found.start())
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["close"] or found["close2"]:
            if name == "p" and not any(n == "p" for n, _, _ in open_):
                out.append(Piece("p", None))
                continue
            close({name}, name in HOLDERS)
            out.append(Piece("/" + name, None))
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            out.append(Piece(name, None))
            continue
        own = attributes(found["rest"] or found["rest2"] or "")
        if name in BLOCKS:
            close({"p"}, False)
            if name in ENDS:
                close(ENDS[name], False)
        out.append(Piece(name, None))
        if name in VOID:
            continue
        why = _beside(name, own)
        if name == "header" and any(n == "article" for n, _, _ in open_):
            why = ""  # an article's own heading
        marking = (name in ("article", "main") or own.get("role", "").lower() in ("article", "main") or "articlebody" in own.get("itemprop", "").lower()) and not why
        if marking and shuts and not any(w == "firm" for _, w, _ in open_):
            # An element beside the text that was left open, or a form round the whole page, ends where the article begins.
            open_[:] = [(n, "", m) for n, _, m in open_]
            shuts = 0
        open_.append((name, why, marking))
        links += name == "a"
        shuts += bool(why)
        marks += marking
        if name in BLOCKS:
            block = name
    text(at, len(page))
    return out


def blocks(chosen: list[Piece]) -> str:
    """The text of the pieces: references decoded, white space in a block one space, blocks two line ends apart."""
    out, own = [], []

    def end() -> None:
        joined = " ".join(html.unescape("".join(own)).split())
        if joined:
            out.append(joined)
        own.clear()

    for piece in chosen:
        if piece.text is not None:
            if piece.shut:
                continue
            own.append(piece.text)
        elif piece.name.lstrip("/") in BLOCKS:
            end()
        elif piece.name == "br":
            own.append(" ")
    end()
    return "\n\n".join(out)
