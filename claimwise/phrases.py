"""Clauses for generated accident reports (German), and how reports are put together from them.

A report is a plan: parts in an order, one clause per part. A clause belongs to a
tag (a kind of incident, such as ``parked``) or to all (empty tag), and may hold one ``{}`` for
the value of its part: the vehicle, or a number drawn for it. The part ``harm`` joins
several items. Callers may pass their own book, also from a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from claimwise.schemas import CASE_TYPES

#: Parts whose ``{}`` is a number, with its least value, step and count of values.
NUMBERS = {"pace": (20, 10, 8), "bystanders": (1, 1, 4)}
#: Tags of a case type and severity bucket, the most special first; the empty tag comes last.
COLLISIONS = {"Front Collision": "front", "Rear Collision": "rear", "Side Collision": "side"}
STANDING = {"Parked Car": "parked", "Vehicle Theft": "stolen"}


def tags(case: str, level: str) -> list[str]:
    if case in COLLISIONS:
        return [f"{COLLISIONS[case]} {level}", COLLISIONS[case], f"driving {level}", "driving", ""]
    return [STANDING[case], ""]


@dataclass(frozen=True)
class PhraseBook:
    """``parts``: part -> tag -> clauses. ``plans``: tag -> orders of parts, one drawn per report; a plain list is for all tags.

    ``harm``: tag -> (least, most) items of the part ``harm``.
    """

    parts: dict[str, dict[str, list[str]]]
    plans: dict[str, list[list[str]]] | list[list[str]]
    harm: dict[str, tuple[int, int]]

    def __post_init__(self):
        if not isinstance(self.plans, dict):
            object.__setattr__(self, "plans", {"": self.plans})
        for plan in (p for plans in self.plans.values() for p in plans):
            unknown = [p for p in plan if p not in self.parts]
            if unknown:
                raise ValueError(f"unknown parts {unknown}")
        lacking = [c for c in CASE_TYPES for level in ("major", "minor") if not any(self.plans.get(t) for t in tags(c, level))]
        if lacking:
            raise ValueError(f"no plan for {sorted(set(lacking))}")
        for case in CASE_TYPES:
            for level in ("major", "minor"):
                items, (least, most) = self.pool("harm", case, level), self.harm_range(case, level)
                if len(set(items)) != len(items) or not 0 < least <= most <= len(items):
                    raise ValueError(f"{case}: harm needs distinct items and 0 < least <= most <= their number")
        if any(c.count("{}") > 1 for by_tag in self.parts.values() for clauses in by_tag.values() for c in clauses):
            raise ValueError("a clause holds at most one {}")

    def pool(self, part: str, case: str, level: str) -> list[str]:
        """Clauses of the most special tag that has any; none leaves the part out."""
        return next((self.parts[part][t] for t in tags(case, level) if self.parts[part].get(t)), [""])

    def plans_of(self, case: str, level: str) -> list[list[str]]:
        """Plans of the most special tag that has any."""
        return next(self.plans[t] for t in tags(case, level) if self.plans.get(t))

    def harm_range(self, case: str, level: str) -> tuple[int, int]:
        return next(self.harm[t] for t in tags(case, level) if t in self.harm)


def book_from_table(table: DataFrame, plans: dict[str, list[list[str]]] | list[list[str]], harm: dict[str, tuple[int, int]]) -> PhraseBook:
    """Book from rows ``part, tag, text``; a phrase table is small, so it is read whole."""
    parts: dict[str, dict[str, list[str]]] = {}
    for part, tag, text in sorted(tuple(r) for r in table.select("part", "tag", "text").distinct().collect()):
        parts.setdefault(part, {}).setdefault(tag, []).append(text)
    return PhraseBook(parts, plans, harm)


_AREAS = ("vorn", "hinten", "seitlich")
_SMALL = [f"{kind} {area}" for kind in ("Kratzer", "Beule", "loses Teil", "gerissene Leuchte", "abgeplatzter Lack") for area in _AREAS]
_LARGE = [f"{kind} {area}" for kind in ("erheblich verformtes Blech", "Bruch eines Trägers", "zersprungenes Glas", "gestauchte Achse") for area in _AREAS]

DEFAULT_BOOK = PhraseBook(
    parts={
        "style": {"": ["Kurzmeldung:", "Bericht des Halters:", "Nachtrag zur Akte:"]},
        "opening": {
            "": ["Betroffen: {}.", "Es geht um {}.", "Akte zu {}.", "Versichertes Fahrzeug ist {}."],
            "stolen": ["Vermisst wird {}.", "Gesucht: {}."],
        },
        "moment": {"": ["Es war noch dunkel.", "Die Sonne stand hoch.", "Der Feierabend begann.", "Die Schule war gerade aus.", "Der Markt baute ab."]},
        "sky": {"": ["Die Straße war trocken.", "Wasser stand auf der Fahrbahn.", "Eis lag auf dem Weg.", "Man sah kaum zwanzig Meter weit.",
                     "Böen drückten gegen die Tür.", "Laub klebte auf dem Asphalt.", "Hagel setzte ein."]},
        "pace": {"driving": ["Der Tacho zeigte {} km/h.", "Gefahren wurden etwa {} km/h.", "Mehr als {} km/h waren es nicht.",
                             "Erlaubt waren dort {} km/h.", "Wir rollten mit {} km/h."]},
        "event": {
            "front": ["Beim Abbiegen kam ein Transporter entgegen.", "Ein Baumstamm lag im Weg.", "Die Bremse griff zu spät.",
                      "Ein Reh sprang aus dem Graben.", "Der Vordermann hielt ohne Grund."],
            "rear": ["Am Stauende drückte uns ein Kombi nach vorn.", "Beim Anfahren rollte ein Bus auf.", "An der Schranke schob uns ein Laster an.",
                     "Vor dem Zebrastreifen fuhr jemand auf.", "Beim Einfädeln traf uns ein Lieferwagen von hinten."],
            "side": ["Auf der Kreuzung schnitt ein Taxi den Weg.", "Ein Anhänger scherte aus.", "Ein Radfahrer kam aus der Gasse.",
                     "Im Kreisel zog ein Wagen herüber.", "Aus der Einfahrt stieß ein Traktor vor."],
            "parked": ["Der Platz daneben wurde zu eng genommen.", "Ein Müllwagen rangierte vor dem Haus.", "Über Nacht streifte jemand die Tür.",
                       "Ein Einkaufswagen rollte dagegen."],
            "stolen": ["Die Garage war aufgebrochen.", "Am Bahnhof war die Parklücke leer.", "Der Zweitschlüssel fehlt.", "Der Abschleppdienst weiß von nichts."],
        },
        "harm": {
            "driving minor": _SMALL,
            "driving major": [*_LARGE, *_SMALL],
            "parked": _SMALL,
            "stolen": ["Papiere im Handschuhfach", "Werkzeug im Kofferraum", "Kindersitz auf der Rückbank", "Ortung nicht eingebaut"],
        },
        "cabin": {
            "driving major": ["Die Luftsäcke haben sich gefüllt.", "Innen sind die Airbags offen.", "Vorn hat ein Airbag ausgelöst."],
            "driving minor": ["Die Airbags blieben zu.", "Kein Airbag hat ausgelöst.", "Die Warnleuchte der Airbags blieb aus."],
            "parked": ["Im Wagen saß niemand.", "Die Alarmanlage sprang an.", "Innen ist alles heil."],
        },
        "bystanders": {"": ["", "{} Zeugen haben sich gemeldet.", "{} Zeugen standen an der Haltestelle.", "Namen von {} Zeugen liegen bei."],
                       "stolen": ["", "{} Zeugen hörten Lärm."]},
        "authority": {"": ["", "Die Polizei hat ein Aktenzeichen vergeben.", "Eine Streife der Polizei nahm alles auf.", "Die Polizei kam nicht zum Ort."],
                      "stolen": ["Die Polizei fahndet."]},
        "recovery": {"driving": ["", "Ein Kran hob den Wagen auf den Laster.", "Der Wagen fuhr allein weiter.", "Freunde zogen den Wagen in den Hof."]},
    },
    plans={
        "driving": [
            ["style", "opening", "event", "harm", "cabin", "authority"],
            ["moment", "sky", "event", "pace", "opening", "harm", "bystanders", "recovery"],
            ["opening", "moment", "pace", "sky", "event", "bystanders", "harm", "cabin", "recovery", "authority"],
            ["style", "sky", "opening", "pace", "event", "cabin", "harm", "recovery", "bystanders"],
        ],
        "parked": [
            ["style", "opening", "event", "harm", "cabin", "authority"],
            ["moment", "sky", "event", "opening", "harm", "bystanders"],
        ],
        "stolen": [
            ["style", "opening", "event", "harm", "authority"],
            ["moment", "event", "opening", "bystanders", "harm", "authority"],
        ],
    },
    # fixed values: how many items a report names
    harm={"driving major": (3, 5), "driving minor": (2, 4), "parked": (2, 4), "stolen": (2, 3)},
)
