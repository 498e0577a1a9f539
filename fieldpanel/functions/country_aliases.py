"""Country spellings and the one name each is known by."""

# Alternative spelling (lower case, trimmed) -> standard name.
COUNTRY_ALIASES = {
    "côte d'ivoire": "ivory coast",
    "cote d'ivoire": "ivory coast",
    "congo, dem. rep.": "democratic republic of congo",
    "congo, rep.": "republic of congo",
    "democratic republic of the congo": "democratic republic of congo",
    "congo (democratic republic of the)": "democratic republic of congo",
    "ethiopia pdr": "ethiopia",
    "the former yugoslav republic of macedonia": "north macedonia",
    "macedonia": "north macedonia",
    "korea, dem. people's rep.": "north korea",
    "democratic people's republic of korea": "north korea",
    "korea, rep.": "south korea",
    "republic of korea": "south korea",
    "china, mainland": "china",
    "china, hong kong sar": "hong kong",
    "china, taiwan province of": "taiwan",
    "china, macao sar": "macao",
    "united republic of tanzania": "tanzania",
    "bolivia (plurinational state of)": "bolivia",
    "venezuela (bolivarian republic of)": "venezuela",
    "venezuela, rb": "venezuela",
    "iran (islamic republic of)": "iran",
    "lao pdr": "laos",
    "lao people's democratic republic": "laos",
    "republic of moldova": "moldova",
    "viet nam": "vietnam",
    "eswatini": "swaziland",
    "cabo verde": "cape verde",
    "brunei darussalam": "brunei",
    "syrian arab republic": "syria",
    "timor-leste": "east timor",
    "russian federation": "russia",
    "united states of america": "united states",
    "czechia": "czech republic",
    "slovak republic": "slovakia",
    "yugoslav sfr": "yugoslavia",
    "serbia and montenegro": "serbia",
    "sudan (former)": "sudan",
    "ussr": "russia",
    "occupied palestinian territory": "palestine",
    "west bank and gaza": "palestine",
    "micronesia (federated states of)": "micronesia",
    "bosnia and herzegovina": "bosnia",
    "trinidad and tobago": "trinidad",
    "antigua and barbuda": "antigua",
    "saint kitts and nevis": "st. kitts and nevis",
    "saint lucia": "st. lucia",
    "saint vincent and the grenadines": "st. vincent and the grenadines",
    "guinea-bissau": "guinea bissau",
}
