"""Curated rule sets of the catalogue."""

from __future__ import annotations

# Results depend on these words and codes, so they are kept as published.
SUPPORTED_CLASSES = ["M1", "M1G", "N1", "N1G", "M2", "M2G", "M3", "M3G"]
POWERTRAINS = ["petrol", "diesel", "hybrid", "phev", "electric"]
VEHICLE_TYPES = ["passenger", "light_truck", "minibus", "van", "motorhome", "bus", "special", "pickup"]
MOTORHOME_GROUPS = ["29"]
MINIBUS_GROUPS = ["35"]
BUS_GROUPS = ["37", "38", "39", "40", "41", "42", "43", "44", "45", "46", "47"]
SPECIAL_GROUPS = [
    "23", "25", "27", "31", "32", "33", "36", "48", "50", "51", "52", "53", "54", "55", "57", "58", "59", "60", "62", "63", "64", "65", "66", "67", "68", "69", "70",
]
SPECIAL_BODIES = ["SB", "SC", "SD", "SF", "SG", "SH", "SL", "SM"]
BUS_BODIES = ["C" + letter for letter in "ABCDEFGHIJKLMNOPQRSTUVWX"]
BODY_LABELS = {
    "AA": "Sedan", "AB": "Viistoperä", "AC": "Farmari", "AD": "Coupé", "AE": "Avoauto", "AF": "Tila-auto", "SA": "Matkailuauto", "BB": "Pakettiauto",
    "BA": "Avolava-auto", "BE": "Avolava-auto",
}
BRAND_SUFFIXES = [
    "gmbh & co. kg", "gmbh & co kg", "gmbh & co", "gmbh", "d.o.o.", "d.o.o", "limited", "ltd", "s.p.a.", "s.p.a", "s.r.l.", "s.r.l", "s.r.o.", "s.r.o", "srl", "spa",
    "inc", "a/s", "a.s.", "b.v.", "nv", "bv", "plc", "corporation", "corp", "company limited", "company", "oyj", "oy", "ab", "ag", "sa", "kg", "o.o.", "s.coop",
]
BRAND_FIXES = {
    "bww": "BMW", "bmw": "BMW", "volswagen": "Volkswagen", "hundai": "Hyundai", "pösll": "Pössl", "poessl": "Pössl", "burstner": "Bürstner", "garthago": "Carthago",
    "studebacker": "Studebaker", "pacard": "Packard", "ll0yd": "Lloyd", "standart": "Standard", "willys overla": "Willys Overland", "commerce": "Commer",
    "popeda": "Pobeda", "morel": "Morelo", "tricano": "Trigano", "mersedes-benz its system": "Mercedes-Benz", "auto-merc/mercedes-benz sprinter": "Mercedes-Benz",
    "auto-merk/mercedes-benz sprinter": "Mercedes-Benz", "arbeitsgem.volkswagen-m": "Volkswagen", "saxas nutzfahr wrdau": "Saxas Nutzfahrzeuge Werdau",
    "auwaerter, gottlob": "Auwaerter", "g.auwaerter, stgt": "Auwaerter", "g.auwaerter.stlt": "Auwaerter", "adam opel": "Opel", "peugeotduo-line": "Peugeot",
    "salvador caetan": "Caetano", "teve ford": "Ford", "teve transit": "Ford", "teve-volkswagen 580m": "Volkswagen", "tatraplan": "Tatra", "willys jeep": "Willys",
    "willys-knight": "Willys", "armstrong": "Armstrong Siddeley", "graham": "Graham Paige", "karma automotive llc": "Karma", "london taxis international": "Lti",
    "great wall motor": "Great Wall", "matra-simca": "Matra", "talbot-matra": "Matra", "mgb": "Mg", "mga": "Mg", "terraplane hudson": "Terraplane",
    "westfalia mobil": "Westfalia", "fendt-caravan": "Fendt",
}
BRAND_PLACEHOLDERS = ["ks. huom.", "övriga", "omavalmiste", "v-series 60 sp"]
HIDDEN_BRANDS = [
    "autocaravans rimor", "cms auto/mercedes-benz", "cuby iveco", "warmiaki/mercedes-benz sprinter", "daimlerchrysler-hymer", "spartan fleetwood",
    "ac cobra shelby 427", "bl cars", "magyar suzuki (h)", "santana (e)", "al-ko", "palfinger", "humbaur", "r.m.trailers", "kerstner", "pollmann", "remetz",
    "truckmasters", "umesläp", "carbodies", "edward davies commercials",
]
KEPT_MODELS = [
    ("faw", "ehs9"), ("wolseley", "444"), ("bugatti", "type57cstelvio"), ("irizar", "i81498375"), ("irizar", "i61537"), ("irizar", "161235efficient"),
    ("irizar", "161335efficient"), ("aion", "ut"), ("aion", "v"), ("gac", "aionv"), ("rivian", "r1t"), ("zeekr", "001"), ("skywell", "et5"), ("skywell", "be11"),
]
UNKNOWN_MODELS = ["tuntematon", "unknown", "eitiedossa", "muu", "other"]
ENGINE_WORDS = (
    r"\b(?:tfsi|tsi|tdi|gdi|mpi)\s+e\b"
    r"|\b(?:hybrid|hybridi|phev|plugin[\s-]*hybrid|plug[\s-]*in(?:[\s-]*hybrid)?|lataushybridi|mild[\s-]*hybrid|electric|elektro|sähk[öo]|bensiini|petrol|diesel|"
    r"kaasu|gas|cng(?!-)|lpg(?!-)|bifuel|flexifuel|e85|battery[\s-]*electric)\b"
    r"|\b(?:tdi|tsi|tfsi|fsi|sdi|gdi|mpi|mpfi|cdi|cdti|tdci|hdi|bluehdi|dci|crdi|jtd|multijet|d-?4-?d|ecoboost|ecotec|vtec|vvti|multiair|twinair|e-?tech|skyactiv|"
    r"puretech|thp|vti|twinturbo|bluetec|bluetech|[ck]ompressor|komp|turbodiesel|dpf)\b"
)
BODY_WORDS = (
    r"\b(?:farmari|viistoper[äa]|avoauto|avolava|umpikorinen|monik[äa]ytt[öo]ajoneuvo|matkailuauto|variant|sportback|avant|tourer|combi|kombi|estate|station\s+wagon|"
    r"sports\s+tourer|break|turnier|sw|stw|gran\s+turismo|gran\s+coupe|sport\s+turismo)\b"
)
SERIES_WORDS = r"\b(?:sarja|sarjan|serie|series|ser|reihe|luokka|klass|class)\b"
TECHNICAL = (
    r"^\d+(?:[.,]\d+)?\s*(?:cdi|tdi|tsi|tdci|hdi|d-?4d|fsi|tfsi|gdi|mpi|sdi|dci|jtd|multijet)$|\b[2-5]\s*d\b|\b\d+\s*ov\b|\d+\s*cm3|\d+[.,]\d|/\d{2,4}|-\d{3,}|"
    r"-[A-Z]{2}\d{1,4}\b|^(?:19|20)\d{2}\s+\S|^\d{5,}(?:[^0-9a-z]|$)|\b(?:umpikorinen|viistoperä|avolavakuorma-auto|monikäyttöajoneuvo|yksikerroksinen|matalalattiainen)\b|"
    r"\b(?:4x4|4motion|4matic|automatic|automaatti|dsg\d*)\b"
)
VARIANT_BODY = (
    r"\b(?:sedan|hatchback|cabriolet|coupe|coupé|touring|st[wm]|farmari|viistoper[äa]|avoauto|avolava|umpikorinen|monik[äa]ytt[öo]ajoneuvo|matkailuauto|combi|kombi|"
    r"mpv|kasten|doppel)\b"
)

#: Parameters of visibility and trust.
SOURCE_YEAR = 2026
TRUSTED_TOTAL = 100
MIN_MAKE_TOTAL = 2
MIN_MODEL_TOTAL = 2
MIN_MODEL_YEAR = 1990
#: Misspelled models, by make in small letters and model key, and their right spelling; a longer list is passed in.
MODEL_FIXES = {
    "skoda": {"ostavia": "Octavia", "oktavia": "Octavia", "suberb": "Superb", "oktaviascout": "Octavia Scout"},
    "volkswagen": {
        "passt": "Passat", "trasporter": "Transporter", "transportter": "Transporter", "transorter": "Transporter", "tranporter": "Transporter", "tiquan": "Tiguan",
        "cafter": "Crafter", "shran": "Sharan", "sharon": "Sharan", "saharan": "Sharan", "toureg": "Touareg", "newbeetlecapriolet": "New Beetle Cabriolet",
        "golfgabriolet": "Golf Cabriolet", "kleinbuss": "Kleinbus", "multivanstarline": "Multivan Startline",
    },
    "toyota": {
        "landcruicer": "Land Cruiser", "landgruiser": "Land Cruiser", "landcuiser": "Land Cruiser", "higlander": "Highlander", "vanquard": "Vanguard", "rav": "Rav4",
        "landcruiser150series9": "Land Cruiser 150",
    },
    "ford": {
        "trasnsit": "Transit", "transitcuistom": "Transit Custom", "tranitcustom": "Transit Custom", "transitconnec": "Transit Connect", "mustan": "Mustang",
        "mondeohydrid": "Mondeo Hybrid", "aglia": "Anglia", "tunderbird": "Thunderbird", "thundebird": "Thunderbird", "fairline": "Fairlane",
        "streetkaa": "Street Ka", "transitpostyle": "Transit PROSTYLE", "rancher": "Ranchero", "prefekt": "Prefect", "modella": "Model A",
    },
    "mercedes-benz": {
        "srinter": "Sprinter", "spriter": "Sprinter", "sprintter": "Sprinter", "spriinter": "Sprinter", "spinter": "Sprinter", "vklassse": "V-Klasse",
        "vklase": "V-Klasse", "vitotouren": "Vito Tourer", "vitotouner": "Vito Tourer", "vitotouer": "Vito Tourer", "turismorhdl": "Tourismo RHD-L",
        "flobyflaksrinter": "Floby Flak Sprinter", "flobyflacksprinter": "Floby Flak Sprinter", "gelendewagen": "Geländewagen",
    },
    "mitsubishi": {"otlander": "Outlander", "outlanderphew": "Outlander PHEV", "pajeromonter": "Pajero/Montero", "mitsubishil200": "L200"},
    "kia": {"sportace": "Sportage"},
    "renault": {"traffic": "Trafic", "mecanescenic": "Megane Scenic", "clioetechhydrid": "CLIO (E-Tech Hybrid)"},
    "subaru": {"forrester": "Forester", "legasy": "Legacy", "imbreza": "Impreza", "lecacygtb": "Legacy GT-B"},
    "citroen": {"jumby": "Jumpy"},
    "tesla": {"modess": "Model S"},
    "hyundai": {"ionic": "Ioniq"},
    "peugeot": {"patner": "Partner"},
    "suzuki": {"grantvitara": "Grand Vitara"},
    "jeep": {"wrankler": "Wrangler", "grancherokee": "Grand Cherokee"},
    "land rover": {"rangerrover": "Range Rover", "rangeroverevogue": "Range Rover Evoque", "rangeroverspor": "Range Rover Sport"},
    "chrysler": {"grandvoager": "Grand Voyager", "sepringconvertible": "Sebring Convertible"},
    "fiat": {"dugato": "Ducato", "dublo": "Doblo", "defthleffs": "Dethleffs", "euramobiel": "Euramobil", "affinitycambervan": "AFFINITY CAMPER VAN"},
    "porsche": {"boxter": "Boxster", "boxters": "Boxster S", "cayannes": "Cayenne S"},
    "scania": {"omnierpress": "OmniExpress", "cityewide": "Citywide", "inerlink": "Interlink"},
    "dodge": {"challanger": "Challenger", "callenger": "Challenger", "challangerrt": "Challenger R/T"},
    "honda": {"strem": "Stream", "legent": "Legend"},
    "cadillac": {"escallade": "Escalade", "coupedewille": "Coupe de Ville"},
    "opel": {
        "kadet": "Kadett", "compovan": "Combo Van", "recorde": "REKORD-E", "record": "Rekord", "olympiarecord": "Olympia Rekord", "kadetcoupe": "Kadett Coupe",
        "astrastasionwagon": "Astra Station Wagon",
    },
    "mg": {"marvelelectric": "Marvel R Electric", "marvellelectric": "Marvel R Electric"},
    "audi": {"etronssportpack": "e-tron S Sportback"},
    "chevrolet": {
        "corvettestingay": "Corvette Stingray", "corvettestringray": "Corvette Stingray", "avalance": "Avalanche", "abache": "Apache",
        "fleetsidepickud": "Fleetside Pick Up", "biscaune": "Biscayne", "masterdelux": "Master Deluxe",
    },
    "mercury": {"coucar": "Cougar", "montrey": "Monterey", "grandmarguis": "Grand Marquis", "monteclair": "Montclair", "cyklonegt": "Cyclone GT"},
    "plymouth": {"satelite": "Satellite"},
    "bentley": {"bentaygahydrid": "Bentayga Hybrid", "bentayagahybrid": "Bentayga Hybrid", "continentagtspeed": "Continental GT Speed"},
    "lincoln": {"navicator": "Navigator", "towncarlimosine": "TOWN CAR Limousine"},
    "oldsmobile": {"nintyeight": "Ninety Eight"},
    "pontiac": {"firebirtformula": "Firebird Formula"},
    "lancia": {"deltahfintergrale": "Delta HF Integrale"},
    "smart": {"fourtwo": "Fortwo"},
    "saab": {"sonetiii": "Sonett III"},
    "nissan": {"kingcap": "King Cab", "doublecap": "Double Cab", "navaradoblecab": "Navara Double Cab", "kingcapnavara": "KING CAB Navara"},
    "alfa romeo": {"breda": "Brera"},
    "seat": {"leonsporttourerst": "LEON SPORTOURER ST", "leonsporttourersst": "LEON SPORTOURER ST"},
    "mini": {"coopercaprio": "Cooper Cabrio"},
    "alpina": {"bmwalbinab6coupeswitchtronic": "B6 Coupe Switch-Tronic"},
    "volvo": {"volvors60": "R + S60"},
}
#: How a make is also written before a model, by the make; and further spellings of a make, in small letters, that are glued to models.
MODEL_MAKES = {
    "Mercedes-Benz": ["Mercedes-Benz", "Mercedes Benz", "Mercedesbenz", "Mercedes", "M-B", "M.B.", "MB"],
    "Volkswagen": ["Volkswagen", "VW"],
}
MORE_MAKES = {"adria": ["adriatik"]}
