"""Regular expressions of the line rules, built from phrases: a blank stands for any white space between words."""

from __future__ import annotations

import re

#: Letters, digits and the underscore, as Python counts them; Java's own class is ASCII.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s]"


def phrase(text: str) -> str:
    return r"\s+".join(re.escape(w).replace("’", "'") for w in text.split(" "))


def any_of(*parts: str) -> str:
    return f"(?:{'|'.join(parts)})"


def line(*starts: str, flags: str = "iu") -> str:
    """Matches from the start of a line, in any case."""
    return f"(?{flags})^{any_of(*starts)}"


def _then(rest: str, *phrases: str) -> list[str]:
    return [phrase(p) + rest for p in phrases]


PAGE_NUMBER = line(r"\s*[0-9]+\s*$", r"\s*-\s*[0-9]+\s*-\s*$", r"\s*(?:page\s+)?[0-9]+\s*/\s*[0-9]+\s*$")
CAPTION = line(r"image\s*:", r"(?:fig(?:ure|\.)?|graphique)\s+[0-9]+\s*:")
UPDATE = line(*_then(r"\s*:", "last update", "mise à jour", "dernière mise à jour"), r"updated?\s*:")

_KINDS = any_of("général", "détaillé", "technique")
_TOC_TITLES = any_of(phrase("table des matières"), "sommaire", rf"sommaire\s+{_KINDS}", phrase("index des matières"))
TOC_HEADER = line(
    rf"{_TOC_TITLES}\s*$",
    rf"\*\*{_TOC_TITLES}\*\*\s*$",
    rf"{any_of(phrase('table of contents'), 'contents')}\s*$",
    rf"plan\s+{any_of('du', phrase('de la'))}\s+{any_of('manuel', 'livre', 'document', 'ouvrage')}\s*$",
)
TOC_HEADER_NAMES = tuple(["contents", "table of contents", "table des matières", "index des matières", "sommaire", *(f"sommaire {k}" for k in ("détaillé", "général", "technique"))])
TOC_ENTRY_EXACT = any_of(
    r"^\*\*[0-9]+\s*(?:•\s*)?(?:\*\*)?.+\*\*\s*[0-9]+\s*\*\*\s*$",
    r"^[0-9]+\.[0-9]+\s+\S.+?\s+[0-9]{1,3}$",
    r"^\*\*.+\*\*\s+\*\*(?:[0-9]{1,4}|[CDILMVX]+)\s*\*\*\s*$",
    r"\.{3,}\s*[0-9]{1,4}\s*$",
)
TOC_ENTRY_START = line(r"\*\*" + phrase("tables de conversion") + r"\*\*", r"\*\*(?:bibliographie|index|annexe)\b")
TOC_SHORT_END = r"\s[0-9]{1,3}$"
TOC_SHORT_START = line(r"[0-9]+\s*•", r"[0-9]+\.[0-9]+", r"[a-zà-ü]")
HEADING_START = r"^#{1,6}\s+"

FRONT_MATTER = line(
    r"isbn\s+[-0-9x]+", r"www\.\S+", r"©\s*[0-9]{4}", r"[0-9]+e\s+édition\s*$", r"[0-9]+,\s*rue\s+", r"istockphoto\.com", r"prime\s+images/",
    *_then("", "illustration de couverture", "graphisme de couverture"), phrase("mise en page") + r"\s*:", r"[0-9]{4}\s+" + phrase("pour la nouvelle présentation"),
)
CONTENT_START = line(r"#{1,6}\s+", r"[0-9]+\.[0-9]+\s+\S", r"\*\*(?:introduction|préface|avant-propos|chapitre|sommaire)\b")

_YEAR = any_of(r"19[0-9]{2}", r"20[0-9]{2}")
_RESERVED = r"droits?\s+(?:d[e']\s*)?(?:reproduction\s+)?(?:strictement\s+)?r[eé]serv[eé]s?"
COPYRIGHT = "(?iu)" + any_of(
    "copyright", "confidential", rf"©.*{_YEAR}", rf"\(c\).*{_YEAR}", _RESERVED, *map(phrase, ("all rights reserved", "document protégé", "propriété intellectuelle", "reproduction interdite")),
    r"ne\s+pas\s+(?:distribuer|diffuser|reproduire)", r"usage\s+(?:strictement\s+)?(?:personnel|privé)",
)

_COLON = r"\s*:"
PAGE_HEADER = line(
    *_then(_COLON, "date de publication", "pour toute question", "cet article est issu de", "document téléchargé le", "pour le compte"),
    rf"photo{_COLON}", rf"réf\.{_COLON}", rf"par\s+(?:email|mail|téléphone){_COLON}",
    "keywords", "mots-clés", "feuilleter", "connexion", r"immeuble\s+",
    *map(phrase, ("accès annonceur", "mon compte", "le magazine", "voir le sommaire", "service relation clientèle", "s'inscrire aux newsletters", "consulter l'intégralité")),
    *map(phrase, ("en poursuivant votre navigation", "techniques de l'ingénieur", "résumé cet article", "abstract this article")),
    r"(?:archive|installations|suivez-nous)$", phrase("plus de photos") + "$", r"[0-9]+/[0-9]+$", r"[0-9]{2}/[0-9]{2}/[0-9]{4}$",
    r"par\s+[a-z][a-z]+.*[a-z][a-z]+", r".*cookies.*statistiques", r".*larpf\.fr/",
)

EMAIL = r"\b[A-Za-z0-9.+_%-]+@[A-Za-z0-9-.]+\.[A-Za-z|]{2,}\b"
URLS = tuple(rf'(?i){start}[^\s<>"{{}}|\\^`\[\]]+' for start in (r"https?://", r"www\.", r"ftp://"))

MONTHS = "août avril décembre février janvier juillet juin mai mars novembre octobre septembre".split()
DATES = (r"\b[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4}\b", r"\b[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}\b", rf"(?iu)\b(?:{'|'.join(MONTHS)})\s+[0-9]{{4}}\b")
AMOUNT = r"\b[0-9]+[.,]?[0-9]*\s*(?:[$%€]|USD|EUR)\b"
CAPITALS = r"\b[A-Z]{2,}(?:\s+[A-Z]{2,})*\b"

#: Frequent French words that are never keywords.
STOP_WORDS = frozenset(
    """aimer ainsi aller alors aussi avec avoir bien celle celles celui cette ceux chez comme croire dans depuis devoir dire donc donner encore enfin
    faire falloir mais mettre parler passer plus pour pouvoir prendre puis quel quelle quelles quels sans savoir sous tous tout toute toutes trouver
    très venir vers voir vouloir être""".split()
)


def _terms(first: str, rest: str) -> str:
    """The boundary holds for the first alternative only; the other ones match inside words as well."""
    return rf"\b{first}|" + "|".join(x.replace("_", " ") for x in rest.split())


DOMAIN_TAGS = {
    "froid": _terms("froid", "chambre_froide frigorifique groupe_froid refrigeration réfrigération"),
    "climatisation": _terms("climatisation", r"clim\b cta drv split traitement_d'air vrv"),
    "pompe_a_chaleur": r"\bpac\b|" + "|".join(("aerothermie", "aérothermie", "pompe à chaleur")),
    "fluide_frigorigene": _terms("fluide", "co2 frigorig[eè]ne hfc hfo propane r134a r290 r32 r407c r410a r744"),
    "pression": _terms("pression", r"bar\b detendeur détendeur epreuve épreuve soupape"),
    "temperature": _terms("temp[eé]rature", "condensation evaporation évaporation sous-refroidissement surchauffe"),
    "debit": _terms("d[eé]bit", "kg/h l/s m3/h m³/h"),
    "puissance": _terms("puissance", r"capacit[eé] charge_thermique kw\b watt"),
    "norme": _terms("norme", r"atex ce\b directive en_378 erp f-gas nf_en r[eé]glement"),
    "maintenance": _terms("maintenance", "contr[oô]le entretien inspection nettoyage v[eé]rification"),
}
LABELS = {
    "norme_reglementation": _terms("norme", "arr[eê]t[eé] conformit[eé] directive en_378 f-gas nf_en obligation r[eé]glement"),
    "dimensionnement": _terms("dimensionnement", "abaque calcul charge_thermique d[eé]bit formule perte_de_charge puissance s[eé]lection"),
    "depannage": _terms("d[eé]pannage", "alarme cause code_erreur d[eé]faut diagnostic panne rem[eè]de sympt[oô]me"),
    "installation_mise_en_service": _terms("installation", "brasage charge implantation mise_en_service montage raccordement tirage_au_vide"),
    "maintenance": _terms("maintenance", "contr[oô]le_p[eé]riodique entretien inspection nettoyage v[eé]rification"),
    "securite": _terms("s[eé]curit[eé]", "consigne danger epi habilitation inflammable pression_maximale risque toxicit[eé]"),
    "fluide_frigorigene": _terms("fluide", "co2 frigorig[eè]ne gwp hfc hfo prg r134a r290 r32 r407c r410a r744"),
}
PRIORITY_WORDS = tuple("attention conclusion définition important introduction note remarque résumé".split())
PROCEDURE_NAMES = tuple("depann dépann diagnostic procedure procédure troubleshoot".split())
