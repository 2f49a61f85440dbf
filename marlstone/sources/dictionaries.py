"""Term dictionaries: misspelt or short forms of brands and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The forms on the right are corrected to the name on the left.
BRANDS = {
    "Toyota": ["toyoda", "toyot", "toyoya", "toiota", "toyota", "toyotta"],
    "Nissan": ["nisan", "nisson", "nissa", "nisam", "niss", "nissan", "nisssn"],
    "Chevrolet": ["chevi", "chevy", "chevroled", "shevrolet", "chevrolet", "chebrolet", "chevolet", "chevrol", "chebr"],
    "Volkswagen": ["vw", "wv", "folkswagen", "volswagen", "volksvagen", "volkswagen", "wolkswagen", "folcks", "volks", "volksw", "bw"],
    "Hyundai": ["hundai", "hyunday", "hundayi", "hiunday", "hyundai", "hundaai", "jundai", "hiundai"],
    "Honda": ["hoda", "honada", "jonda", "onda"],
    "Mazda": ["masda", "mazada", "mazd", "mazds"],
    "Mitsubishi": ["mitsubichi", "mitsubisi", "mitzubishi", "mitsub", "mitsu", "mitsubushi"],
    "Kia": ["kya", "kia", "quía"],
    "Suzuki": ["susuki", "suzuky", "zusuki", "suzuki"],
    "Mercedes-Benz": ["mercedes", "mercedez", "mercedes benz", "merced"],
    "BMW": ["bmv", "bwm", "bmw", "vemeve"],
    "Renault": ["renauld", "renaul", "reno", "renau"],
    "Peugeot": ["peugeod", "peugot", "peyot", "peugo"],
    "Seat": ["ceat", "seat", "sear"],
    "Cupra": ["cupra", "cupla"],
    "Audi": ["audy", "aody"],
    "Jeep": ["jip", "yip", "jiip", "yeep"],
    "Ford": ["frod", "fford"],
    "Dodge": ["doge", "dodg", "doch"],
    "RAM": ["ran", "ramm"],
    "Fiat": ["fiar", "fiad"],
    "Subaru": ["subaro", "subari"],
    "Acura": ["akura"],
    "Lincoln": ["lincon", "lincol"],
    "Buick": ["buik", "buic"],
    "GMC": ["gmc", "gms"],
    "MG": ["mg"],
    "JAC": ["jac", "jak"],
    "Changan": ["changan", "changam", "changa"],
    "BAIC": ["baic", "baik"],
    "Chirey": ["chirey", "chiry", "cherry"],
}

# Fixed values, likewise for models.
MODELS = {
    "Versa": ["bersa", "verza", "verssa", "besa"],
    "Sentra": ["sentrra", "senttra", "centra"],
    "X-Trail": ["xtrail", "x trail", "x-trail", "extrail"],
    "Kicks": ["kicks", "kics"],
    "March": ["march", "marc"],
    "Frontier": ["frontier", "fronter"],
    "Pathfinder": ["pathfinder", "patfinder"],
    "Jetta": ["yetta", "jeta", "yeta", "jett"],
    "Taos": ["tagun", "taoz"],
    "Tiguan": ["tiguan", "tiguán", "tiguam"],
    "Polo": ["polo", "pol"],
    "Virtus": ["virtus", "birtus"],
    "T-Cross": ["tcross", "t-cross", "t cross"],
    "Nivus": ["nivus"],
    "Corolla": ["corrolla", "corola", "corlla", "coroya"],
    "Yaris": ["yaris", "yari", "yariz"],
    "Hilux": ["hilux", "hilx", "jilux"],
    "RAV4": ["rav4", "rav-4", "rav"],
    "Camry": ["camry", "camri"],
    "Prius": ["prius"],
    "Civic": ["sivic", "cívic", "civiv", "sibic"],
    "CR-V": ["cr-v", "crv", "c-rv"],
    "HR-V": ["hr-v", "hrv", "h-rv"],
    "BR-V": ["br-v", "brv"],
    "City": ["city", "citi"],
    "Fit": ["fit"],
    "CX-5": ["cx-5", "cx5"],
    "CX-3": ["cx-3", "cx3"],
    "CX-30": ["cx-30", "cx30"],
    "CX-50": ["cx-50", "cx50"],
    "CX-90": ["cx-90", "cx90"],
    "Mazda3": ["mazda3", "mazda 3"],
    "Mazda6": ["mazda6", "mazda 6"],
    "Mazda2": ["mazda2", "mazda 2"],
    "Tucson": ["tuczon", "tucsan", "tucsom", "tucsón"],
    "Creta": ["creta", "cretta"],
    "Venue": ["venue", "benue"],
    "Accent": ["accent", "axent"],
    "Palisade": ["palisade"],
    "Aveo": ["aveo", "abeo"],
    "Cavalier": ["cavalier", "kavalier", "cabalier"],
    "Equinox": ["equinocs", "equinox", "ekinox"],
    "Trax": ["tracs", "trax", "traks"],
    "Tracker": ["tracker", "traker"],
    "Onix": ["onix", "onyx"],
    "Captiva": ["captiva", "captiba"],
    "Traverse": ["traverse", "travers"],
    "Suburban": ["suburban", "suburbam"],
    "Tahoe": ["tahoe", "tajo"],
    "Silverado": ["silverado", "silverdo"],
    "Rio": ["rio", "ryo"],
    "Sportage": ["sportaje", "sportage", "esportage"],
    "Seltos": ["seltos", "seltoz"],
    "Forte": ["forte", "fortte"],
    "Sorento": ["sorento", "sorent"],
    "Swift": ["swift", "suift"],
    "Vitara": ["vitara", "bitara"],
    "Ertiga": ["ertiga"],
    "Jimny": ["jimny", "yimny"],
    "Ignis": ["ignis"],
    "Compass": ["compass", "compas", "conpas"],
    "Renegade": ["renegade", "renegeid"],
    "Wrangler": ["wrangler", "rangler"],
    "Cherokee": ["cherokee", "cheroki"],
    "Grand Cherokee": ["grand cherokee"],
    "Duster": ["daster", "duter", "doster"],
    "Kwid": ["kwid", "kuig"],
    "Stepway": ["stepway", "stepuey"],
    "Koleos": ["koleos", "coleos"],
    "Escape": ["escape", "escap"],
    "Ranger": ["ranger", "ranjer"],
    "Bronco": ["bronco", "bronko"],
    "Maverick": ["maverick", "maberick"],
    "Explorer": ["explorer", "esplorer"],
    "Mustang": ["mustang", "mustag"],
    "Ibiza": ["ibiza", "iviza"],
    "Arona": ["arona"],
    "Ateca": ["ateca", "ateka"],
    "Leon": ["leon", "león"],
    "Tarraco": ["tarraco"],
    "Formentor": ["formentor"],
    "Attitude": ["attitude", "atitude"],
    "Durango": ["durango", "durago"],
    "2008": ["2008"],
    "208": ["208"],
    "3008": ["3008"],
    "5008": ["5008"],
    "MG5": ["mg5", "mg 5"],
    "ZS": ["zs"],
    "HS": ["hs"],
    "Marvel R": ["marvel"],
}


def by_form(names: dict[str, list[str]]) -> dict[str, str]:
    """Form to name."""
    return {form: name for name, forms in names.items() for form in forms}


def dictionary(spark: SparkSession, forms: dict[str, str]) -> DataFrame:
    """(term, canonical); a table of fixed size, whatever the data."""
    return spark.createDataFrame(sorted(forms.items()), "term string, canonical string")
