"""The probability that a text is English, by the letters in threes of a few sentences; for texts that are more than plain ASCII."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

#: Sentences that the counts are taken from, made up for this purpose: English first, then other languages.
SAMPLES = {
    "en": "The company opened a new office in the north of the city. We are looking for people who would like to work with us on the next version. This report shows how prices have changed over the last three years and what that means for customers. The cafe opened early and closed late. Please send your questions to the person named above. Their services include shipping, storage and repair of machines. It was founded by two brothers and has been growing since then. General information about the united group of companies limited. High quality products and solutions for building, energy and health. Management consulting, research and development, trading and holding.",
    "de": "Die Firma hat ein neues Büro im Norden der Stadt eröffnet. Wir suchen Menschen, die mit uns an der nächsten Fassung arbeiten möchten. Dieser Bericht zeigt, wie sich die Preise in den letzten drei Jahren geändert haben. Bitte senden Sie Ihre Fragen an die oben genannte Person. Gesellschaft für Wärme, Straßenbau und Größe mit beschränkter Haftung. Hersteller von Möbeln, Geräten und Zubehör für Küchen. Grüße aus München und Köln.",
    "fr": "La société a ouvert un nouveau bureau dans le nord de la ville. Nous cherchons des personnes qui voudraient travailler avec nous sur la prochaine version. Ce rapport montre comment les prix ont changé pendant les trois dernières années. Veuillez envoyer vos questions à la personne nommée ci-dessus. Société générale de l'énergie et des matériaux, fabrication française à côté de l'église.",
    "es": "La empresa abrió una nueva oficina en el norte de la ciudad. Buscamos personas que quieran trabajar con nosotros en la próxima versión. Este informe muestra cómo han cambiado los precios durante los últimos tres años. Envíe sus preguntas a la persona nombrada arriba. Compañía española de construcción, energía y alimentación para niños.",
    "it": "La società ha aperto un nuovo ufficio nel nord della città. Cerchiamo persone che vogliano lavorare con noi alla prossima versione. Questo rapporto mostra come sono cambiati i prezzi negli ultimi tre anni. Inviate le vostre domande alla persona nominata sopra. Azienda italiana di qualità, più servizi per l'industria.",
    "pt": "A empresa abriu um novo escritório no norte da cidade. Procuramos pessoas que queiram trabalhar conosco na próxima versão. Este relatório mostra como os preços mudaram nos últimos três anos. Companhia brasileira de construção, informação e alimentação, não são iguais às outras.",
    "sv": "Företaget har öppnat ett nytt kontor i norra delen av staden. Vi söker människor som vill arbeta med oss på nästa version. Denna rapport visar hur priserna har ändrats under de senaste tre åren. Små hus på ön, kött och bröd för hälsa.",
    "pl": "Firma otworzyła nowe biuro na północy miasta. Szukamy ludzi, którzy chcieliby z nami pracować nad następną wersją. Ten raport pokazuje, jak zmieniły się ceny w ciągu ostatnich trzech lat. Spółka z ograniczoną odpowiedzialnością, łódź i żółw.",
}
#: Letters that no sample has count as if seen this often.
_SMOOTH = 0.02
#: Weight of the whole against a word alone: how many of its threes count as independent.
_INDEPENDENT = 0.6


def _threes(text: str) -> list[str]:
    return [f" {w} "[i : i + 3] for w in re.findall(r"[^\W\d_]+", text.lower()) for i in range(len(w))]


@functools.lru_cache(maxsize=1)
def _tables() -> dict[str, tuple[Counter, float]]:
    found = {k: Counter(_threes(v)) for k, v in SAMPLES.items()}
    kinds = len(set().union(*found.values()))
    return {k: (c, sum(c.values()) + _SMOOTH * kinds) for k, c in found.items()}


def probability(text: str) -> float:
    """P(English) against the other samples, all alike before; letters of another script than Latin are never English. No letters: 1."""
    threes = _threes(text)
    if not threes:
        return 1.0
    if any(c.isalpha() and ord(c) > 0x24F for c in text):
        return 0.0
    logs = {k: _INDEPENDENT * sum(math.log((c[t] + _SMOOTH) / total) for t in threes) for k, (c, total) in _tables().items()}
    most = max(logs.values())
    return math.exp(logs["en"] - most) / sum(math.exp(v - most) for v in logs.values())
