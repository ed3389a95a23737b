"""Fixed dimensions: kinds, countries, currencies, SWIFT tags.

All of them have a constant size, so they may become literals in a plan or broadcast tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

# The kinds of fields and the groups that they belong to.
KINDS = ("BIC", "ACCOUNT_NUMBER", "IBAN", "ISIN", "CFI", "LEI", "SORT_CODE", "PARTICIPANT_ID", "COUNTRY", "CURRENCY", "DATE", "PERCENTAGE", "PERSON_NAME", "ORG_NAME", "EMAIL", "PHONE", "ADDRESS", "ENUM", "FREE_TEXT", "UNKNOWN")
PII_KINDS = ("BIC", "ACCOUNT_NUMBER", "IBAN", "LEI", "SORT_CODE", "PARTICIPANT_ID", "PERSON_NAME", "ORG_NAME", "EMAIL", "PHONE", "ADDRESS", "FREE_TEXT", "UNKNOWN")
IDENTIFIER_KINDS = ("BIC", "ACCOUNT_NUMBER", "IBAN", "ISIN", "CFI", "LEI", "SORT_CODE", "PARTICIPANT_ID")

# ISO 3166 alpha-2 codes, and two more that settlement data uses.
COUNTRY_CODES = (
    "AD AE AF AG AI AL AM AO AQ AR AS AT AU AW AX AZ BA BB BD BE BF BG BH BI BJ BL BM BN BO BQ BR BS BT BV BW BY BZ "
    "CA CC CD CF CG CH CI CK CL CM CN CO CR CU CV CW CX CY CZ DE DJ DK DM DO DZ EC EE EG EH ER ES ET FI FJ FK FM FO FR "
    "GA GB GD GE GF GG GH GI GL GM GN GP GQ GR GS GT GU GW GY HK HM HN HR HT HU ID IE IL IM IN IO IQ IR IS IT JE JM JO JP "
    "KE KG KH KI KM KN KP KR KW KY KZ LA LB LC LI LK LR LS LT LU LV LY MA MC MD ME MF MG MH MK ML MM MN MO MP MQ MR MS MT MU MV MW MX MY MZ "
    "NA NC NE NF NG NI NL NO NP NR NU NZ OM PA PE PF PG PH PK PL PM PN PR PS PT PW PY QA RE RO RS RU RW "
    "SA SB SC SD SE SG SH SI SJ SK SL SM SN SO SR SS ST SV SX SY SZ TC TD TF TG TH TJ TK TL TM TN TO TR TT TV TW TZ "
    "UA UG UM US UY UZ VA VC VE VG VI VN VU WF WS YE YT ZA ZM ZW XS EU"
).split()

# ISO 4217 alpha-3 codes, metals and drawing rights among them.
CURRENCY_CODES = (
    "AED AFN ALL AMD AOA ARS AUD AWG AZN BAM BBD BDT BGN BHD BIF BMD BND BOB BRL BSD BTN BWP BYN BZD CAD CDF CHF CLP CNY COP CRC CUP CVE CZK "
    "DJF DKK DOP DZD EGP ERN ETB EUR FJD FKP GBP GEL GHS GIP GMD GNF GTQ GYD HKD HNL HTG HUF IDR ILS INR IQD IRR ISK JMD JOD JPY KES KGS KHR "
    "KMF KPW KRW KWD KYD KZT LAK LBP LKR LRD LSL LYD MAD MDL MGA MKD MMK MNT MOP MRU MUR MVR MWK MXN MYR MZN NAD NGN NIO NOK NPR NZD OMR PAB "
    "PEN PGK PHP PKR PLN PYG QAR RON RSD RUB RWF SAR SBD SCR SDG SEK SGD SHP SLE SOS SRD SSP STN SVC SYP SZL THB TJS TMT TND TOP TRY TTD TWD "
    "TZS UAH UGX USD UYU UZS VES VND VUV WST XAF XCD XOF XPF YER ZAR ZMW ZWG XAU XAG XPT XPD XDR"
).split()

# Alpha-2, alpha-3 and English names (after ISO 3166; variants behind a bar).
_COUNTRY_NAMES = """
AT AUT Austria|Republic of Austria
AU AUS Australia
BE BEL Belgium|Kingdom of Belgium
BG BGR Bulgaria|Republic of Bulgaria
BR BRA Brazil|Federative Republic of Brazil
CA CAN Canada
CH CHE Switzerland|Swiss Confederation
CL CHL Chile|Republic of Chile
CN CHN China|People's Republic of China
CO COL Colombia|Republic of Colombia
CY CYP Cyprus|Republic of Cyprus
CZ CZE Czechia|Czech Republic
DE DEU Germany|Federal Republic of Germany
DK DNK Denmark|Kingdom of Denmark
EE EST Estonia|Republic of Estonia
EG EGY Egypt|Arab Republic of Egypt
ES ESP Spain|Kingdom of Spain
FI FIN Finland|Republic of Finland
FR FRA France|French Republic
GB GBR United Kingdom|United Kingdom of Great Britain and Northern Ireland
GR GRC Greece|Hellenic Republic
HK HKG Hong Kong|Hong Kong Special Administrative Region of China
HR HRV Croatia|Republic of Croatia
HU HUN Hungary
ID IDN Indonesia|Republic of Indonesia
IE IRL Ireland
IL ISR Israel|State of Israel
IN IND India|Republic of India
IS ISL Iceland|Republic of Iceland
IT ITA Italy|Italian Republic
JP JPN Japan
KR KOR Korea, Republic of|South Korea
LI LIE Liechtenstein|Principality of Liechtenstein
LT LTU Lithuania|Republic of Lithuania
LU LUX Luxembourg|Grand Duchy of Luxembourg
LV LVA Latvia|Republic of Latvia
MC MCO Monaco|Principality of Monaco
MT MLT Malta|Republic of Malta
MX MEX Mexico|United Mexican States
MY MYS Malaysia
NL NLD Netherlands|Kingdom of the Netherlands
NO NOR Norway|Kingdom of Norway
NZ NZL New Zealand
PH PHL Philippines|Republic of the Philippines
PL POL Poland|Republic of Poland
PT PRT Portugal|Portuguese Republic
QA QAT Qatar|State of Qatar
RO ROU Romania
RS SRB Serbia|Republic of Serbia
RU RUS Russian Federation
SA SAU Saudi Arabia|Kingdom of Saudi Arabia
SE SWE Sweden|Kingdom of Sweden
SG SGP Singapore|Republic of Singapore
SI SVN Slovenia|Republic of Slovenia
SK SVK Slovakia|Slovak Republic
TH THA Thailand|Kingdom of Thailand
TR TUR Türkiye|Republic of Türkiye
TW TWN Taiwan, Province of China|Taiwan
UA UKR Ukraine
AE ARE United Arab Emirates
US USA United States|United States of America
VN VNM Viet Nam|Socialist Republic of Viet Nam|Vietnam
ZA ZAF South Africa|Republic of South Africa
"""


def country_rows() -> list[tuple[str, str, str]]:
    """(alpha2, alpha3, name), one row per name."""
    out = []
    for line in _COUNTRY_NAMES.strip().splitlines():
        alpha2, alpha3, names = line.split(" ", 2)
        out += [(alpha2, alpha3, name) for name in names.split("|")]
    return out


@functools.lru_cache(maxsize=1)
def _locale_names() -> tuple[tuple[str, str], ...]:
    """(lower-case English name or alpha-3 code, alpha-2) of every country, as the JVM's own tables have them."""
    from pyspark import SparkContext

    locale = SparkContext._active_spark_context._jvm.java.util.Locale
    english, out = locale.ENGLISH, []
    for code in sorted(set(locale.getISOCountries()) & set(COUNTRY_CODES)):
        place = locale("", code)
        out += [(str(n).lower(), code) for n in (place.getDisplayCountry(english), place.getISO3Country()) if n and ";" not in n and "=" not in n]
    return tuple(out)


def _written_names() -> dict[str, str]:
    """Empty as long as no session runs."""
    from pyspark import SparkContext

    return dict(_locale_names()) if SparkContext._active_spark_context is not None else {}


def country_index() -> dict[str, str]:
    """Lower-case name or alpha-3 code to alpha-2."""
    out = _written_names()
    for alpha2, alpha3, name in country_rows():
        out[name.lower()] = alpha2
        out[alpha3.lower()] = alpha2
    return out


def dim_country(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(country_rows(), "alpha2 string, alpha3 string, name string")


def dim_currency(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in CURRENCY_CODES], "alpha3 string")


def dim_kind(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, k in PII_KINDS, k in IDENTIFIER_KINDS) for k in KINDS], "kind string, is_pii boolean, is_identifier boolean")
