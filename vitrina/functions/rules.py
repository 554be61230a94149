"""Fixed values of the catalog rules: patterns, abbreviations, categories and thresholds; and the object that carries them."""

from dataclasses import dataclass, field

# Whole-word corrections, applied in this order.
TYPOS = ((r"\bDELANTEROANTERO\b", "DELANTERO"), (r"\bUNID\b", "UND"), (r"\bJGO\b", "JUEGO"))

# Abbreviation of a whole token -> word.
ABBREVIATIONS = {
    "DEL": "DELANTERO", "DELANT": "DELANTERO", "TRAS": "TRASERO", "TRA": "TRASERO", "IZ": "IZQUIERDO", "IZQ": "IZQUIERDO",
    "IZQUIER": "IZQUIERDO", "DER": "DERECHO", "DR": "DERECHO", "AMOR": "AMORTIGUADOR", "MOT": "MOTOR", "PTAL": "PUERTA LATERAL",
    "FILT": "FILTRO", "FILTR": "FILTRO", "ACEIT": "ACEITE", "RETROV": "RETROVISOR", "RETRO": "RETROVISOR", "INF": "INFERIOR",
    "PLUMIL": "PLUMILLA", "CORR": "CORREA", "CALAN": "CALANDRIA",
}

# Patterns for pack, volume, case multiplier, viscosity, tire size and platform code.
PACK = r"(?i)\b\d+L?\s?X\s?\d+\s?(?:UN[DI]{0,2})?\b"
VOLUME = r"(?i)\b(\d+(?:[.,]\d+)?)\s?L(?=X|\b)"
CASE_MULTIPLIER = r"(?is)^(.*?)\b(\d+(?:[.,]\d+)?\s?L)\s?X\s?\d+\s?(?:UN[DI]{0,2})?\b"
VISCOSITY = r"(?i)\b\d{1,2}W-?\d{2}\b"
TIRE = r"(?i)\b\d{3}/\d{2}R\d{2}\b"
CODE = r"\b([A-Z]{1,4}\d{0,2}(?:-[A-Z]{1,4}\d{0,2})*)\s*$"

# Categories in order of priority: name, keywords. The first match wins.
CATEGORIES = (
    ("merchandising", ("GORRA", "BOLSO", "LLAVERO", "LIBRETA", "PIJAMA", "CARGADOR", "LE BOUQUET", "CASATORO", "KIT CARRETERA")),
    ("accesorios", ("TAPETE", "TAPIZ")),
    ("emblemas", ("MONOGRAMA", "EMBLEMA")),
    ("filtros", ("FILTRO",)),
    ("frenos", ("PASTILLA", "PLAQUETA", "BANDAS FRENO", "DISCO FRENO", "DISC FRENO", "CAMPANA", "DISC", "FRENO")),
    ("motor_transmision", ("CARTER", "EMBRAGUE", "BOBINA", "BUJIA", "INYECTOR", "CORREA", "CADENA")),
    ("refrigeracion", ("BOMBA AGUA", "BOMBA DE AGUA", "SALIDA AGUA", "CONDENSADOR", "MOTOVENT", "INTERCOOL", "RADIADOR")),
    ("lubricantes", ("ACEITE", "CASTROL", "10W", "15W", "5W", "20W", "80W", "0W")),
    ("llantas_rines", ("LLANTA", "RIN", "COPA RUEDA", "TAPACUBOS", "ENERGY XM2")),
    ("baterias", ("BATERIA",)),
    ("suspension_direccion", ("AMORTIGUADOR", "BRAZO", "GUARDAPOLVO", "RODAMIENT", "TOPE")),
    ("iluminacion", ("FAROLA", "FARO", "STOP", "PROYECTOR")),
    ("vidrios_espejos", ("VIDRIO", "VIDR", "LUNETA", "PARABRISA", "PARABRISAS", "RETROVISOR", "COQUILLA", "COQUIL", "COQUILA", "COLISA", "PLUMILLA", "LIMPIAPARABRISAS")),
    ("carroceria", ("PARACHOQUE", "PARAGOLPE", "PUERTA", "ALETA", "CAPOT", "COFRE", "BAUL", "REJILLA", "CALANDRIA", "CALANDRA", "GRILLA", "ESTRIBOS")),
)
OTHER = "otros"

# How a category's products are to be shown.
PRESENTATIONS = {
    "merchandising": "producto solo sobre fondo limpio, sin modelo humano de preferencia",
    "accesorios": "accesorio individual (tapete/tapiz) mostrado plano o de frente, sin vehiculo",
    "emblemas": "emblema/monograma con el logo legible; aceptable como pieza suelta lo que se verifica es el logo y que este aislado (preferiblemente)",
    "filtros": "filtro individual (cilindrico o panel); sin caja salvo que verifique la marca",
    "frenos": "Si son PASTILLAS: cuenta las pastillas y verifica el eje segun el nombre. Si el nombre dice un eje (delanteras/delantero o traseras/trasero): mostrar 2 pastillas de ESE eje (aceptable 1), NUNCA el set de 4. Si el nombre NO especifica eje ni cantidad (solo 'pastillas de freno'): aceptable 1 o el set de 4. Si son BANDAS/ZAPATAS de freno: el juego comercial de un eje trae 4 zapatas, asi que son aceptables 1, 2 o 4 unidades; NO descartes por cantidad si son bandas del tipo correcto (pero un tambor o campana NO es una banda)",
    "motor_transmision": "componente individual (carter/embrague/bobina/bujia/inyector/correa)",
    "refrigeracion": "componente individual (bomba de agua/condensador/motoventilador)",
    "lubricantes": "envase individual del litraje indicado; el empaque ES el producto (una botella, no multipack). Acepta equivalencias comerciales de litraje: un cuarto de galon (0.946L / 946ml / quart) CUENTA como 1L y viceversa; descarta por litraje solo si el tamano es claramente otro (p.ej. galon o 4L cuando se pide 1L)",
    "llantas_rines": "una llanta o un rin de frente; banda/rin visible completo",
    "baterias": "una bateria individual de frente, etiqueta/marca visible",
    "suspension_direccion": "pieza individual (amortiguador/brazo/rotula), una unidad del lado indicado",
    "iluminacion": "una unidad de la optica (farola/stop/proyector) del lado indicado",
    "vidrios_espejos": "vidrio/espejo/retrovisor individual del lado indicado",
    "carroceria": "panel de carroceria individual (parachoques/puerta/aleta) del lado y modelo indicados",
    "otros": "producto individual centrado, presentacion estandar de catalogo",
}
BASELINE, EXACT_BRAND, WHITE_DOMINANT = "baseline", "exact_brand", "white_dominant"
EXACT_BRAND_CATEGORIES = ("merchandising", "emblemas")

# Thresholds of the candidate filters, and the report's prices.
MIN_SIDE, MAX_RATIO, HASH_DISTANCE, KEEP, WHITE = 400, 3.0, 4, 6, 235
BLOCKED_DOMAINS = ("shutterstock.com",)
PRIORITY_DOMAINS: tuple[str, ...] = ()
PROTOTYPE_BAD_DOMAINS = ("alamy.com", "shutterstock.com", "dreamstime.com", "123rf.com", "istockphoto.com", "pinterest.com")
PROTOTYPE_RIVALS = ("castrol", "mobil", "shell", "valvoline", "motul", "total", "terpel", "havoline", "brembo", "trw", "ferodo")
FREE_SEARCHES, USD_PER_1000_SEARCHES = 100, 5.0
#: USD per million tokens, in and out.
MODEL_PRICES = {"gemini-2.5-flash": (0.30, 2.50), "gemini-2.5-pro": (1.25, 10.00)}


@dataclass(frozen=True)
class Rules:
    """What names are cleaned, read and classified by. Every part can be given anew."""

    typos: tuple[tuple[str, str], ...] = TYPOS
    abbreviations: dict[str, str] = field(default_factory=lambda: ABBREVIATIONS)
    pack: str = PACK
    volume: str = VOLUME
    case_multiplier: str = CASE_MULTIPLIER
    viscosity: str = VISCOSITY
    tire: str = TIRE
    code: str = CODE
    categories: tuple[tuple[str, tuple[str, ...]], ...] = CATEGORIES
    other: str = OTHER
    exact_brand: tuple[str, ...] = EXACT_BRAND_CATEGORIES
    presentations: dict[str, str] = field(default_factory=lambda: PRESENTATIONS)
    #: Platform code -> vehicle; the raw code of a name that is not in it stands for no vehicle.
    vehicle_codes: dict[str, str] = field(default_factory=dict)


DEFAULT = Rules()
