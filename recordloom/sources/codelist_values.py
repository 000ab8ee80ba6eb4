"""The published codes and categories that results must agree on.

The larger mapping from SNOMED codes to ethnic categories, and the ICD-10 infection list, are not packaged; the
caller supplies them as tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# SNOMED codes of antigen test results (code, description, test_result).
ANTIGEN_TESTS = [
    ("1240581000000104", "Severe acute respiratory syndrome coronavirus 2 detected (finding)", "Positive"),
    ("1240591000000102", "Severe acute respiratory syndrome coronavirus 2 not detected (finding)", "Negative"),
    ("1321691000000102", "Severe acute respiratory syndrome coronavirus 2 ribonucleic acid detection result unknown (finding)", "Unknown"),
    ("1322781000000102", "Severe acute respiratory syndrome coronavirus 2 antigen detection result positive (finding)", "Positive"),
    ("1322791000000100", "Severe acute respiratory syndrome coronavirus 2 antigen detection result negative (finding)", "Negative"),
    ("1322821000000105", "Severe acute respiratory syndrome coronavirus 2 antigen detection result unknown (finding)", "Unknown"),
]

# SNOMED codes of COVID-19 infection (code, description, covid_status).
INFECTION_CODES = [
    ("1300721000000109", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 confirmed by laboratory test (situation)", "confirmed"),
    ("1321191000000105", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 procedures simple reference set (foundation metadata concept)", "confirmed"),
    ("1322781000000102", "Severe acute respiratory syndrome coronavirus 2 antigen detection result positive (finding)", "confirmed"),
    ("1300731000000106", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 confirmed using clinical diagnostic criteria (situation)", "confirmed"),
    ("1321181000000108", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 record extraction simple reference set (foundation metadata concept)", "confirmed"),
    ("120814005", "Coronavirus antibody (substance)", "confirmed"),
    ("1240421000000101", "Serotype severe acute respiratory syndrome coronavirus 2 (qualifier value)", "confirmed"),
    ("1321201000000107", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 health issues simple reference set (foundation metadata concept)", "confirmed"),
    ("1321301000000101", "Severe acute respiratory syndrome coronavirus 2 ribonucleic acid qualitative existence in specimen (observable entity)", "confirmed"),
    ("1321811000000105", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin A qualitative existence in specimen (observable entity)", "confirmed"),
    ("1240571000000101", "Gastroenteritis caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1240741000000103", "Severe acute respiratory syndrome coronavirus 2 serology (observable entity)", "confirmed"),
    ("1008541000000105", "Coronavirus ribonucleic acid detection assay (observable entity)", "confirmed"),
    ("1321331000000107", "Arbitrary concentration of severe acute respiratory syndrome coronavirus 2 total immunoglobulin in serum (observable entity)", "confirmed"),
    ("1240511000000106", "Detection of severe acute respiratory syndrome coronavirus 2 using polymerase chain reaction technique (procedure)", "confirmed"),
    ("1321761000000103", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin A detected (finding)", "confirmed"),
    ("1300681000000102", "Assessment using coronavirus disease 19 severity scale (procedure)", "confirmed"),
    ("1240581000000104", "Severe acute respiratory syndrome coronavirus 2 ribonucleic acid detected (finding)", "confirmed"),
    ("1321351000000100", "Arbitrary concentration of severe acute respiratory syndrome coronavirus 2 immunoglobulin M in serum (observable entity)", "confirmed"),
    ("1240521000000100", "Otitis media caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1240411000000107", "Ribonucleic acid of severe acute respiratory syndrome coronavirus 2 (substance)", "confirmed"),
    ("186747009", "Coronavirus infection (disorder)", "confirmed"),
    ("1321241000000105", "Cardiomyopathy caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1240531000000103", "Myocarditis caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1321801000000108", "Arbitrary concentration of severe acute respiratory syndrome coronavirus 2 immunoglobulin A in serum (observable entity)", "confirmed"),
    ("1240561000000108", "Encephalopathy caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1321341000000103", "Arbitrary concentration of severe acute respiratory syndrome coronavirus 2 immunoglobulin G in serum (observable entity)", "confirmed"),
    ("1300671000000104", "Coronavirus disease 19 severity scale (assessment scale)", "confirmed"),
    ("1240551000000105", "Pneumonia caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1240401000000105", "Antibody to severe acute respiratory syndrome coronavirus 2 (substance)", "confirmed"),
    ("1321551000000106", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin M detected (finding)", "confirmed"),
    ("1321541000000108", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin G detected (finding)", "confirmed"),
    ("1322871000000109", "Severe acute respiratory syndrome coronavirus 2 antibody detection result positive (finding)", "confirmed"),
    ("1321321000000105", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin G qualitative existence in specimen (observable entity)", "confirmed"),
    ("1240381000000105", "Severe acute respiratory syndrome coronavirus 2 (organism)", "confirmed"),
    ("1240751000000100", "Coronavirus disease 19 caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
    ("1321311000000104", "Severe acute respiratory syndrome coronavirus 2 immunoglobulin M qualitative existence in specimen (observable entity)", "confirmed"),
    ("1029481000000103", "Coronavirus nucleic acid detection assay (observable entity)", "confirmed"),
    ("1300631000000101", "Coronavirus disease 19 severity score (observable entity)", "confirmed"),
    ("1240391000000107", "Antigen of severe acute respiratory syndrome coronavirus 2 (substance)", "confirmed"),
    ("1240541000000107", "Infection of upper respiratory tract caused by severe acute respiratory syndrome coronavirus 2 (disorder)", "confirmed"),
]

# Ethnic category codes (code, description, broad group).
ETHNICITY_CATEGORIES = [
    ("A", "British", "White"),
    ("B", "Irish", "White"),
    ("C", "Any other White background", "White"),
    ("D", "White and Black Caribbean", "Mixed or multiple ethnic groups"),
    ("E", "White and Black African", "Mixed or multiple ethnic groups"),
    ("F", "White and Asian", "Mixed or multiple ethnic groups"),
    ("G", "Any other mixed background", "Mixed or multiple ethnic groups"),
    ("H", "Indian", "Asian or Asian British"),
    ("J", "Pakistani", "Asian or Asian British"),
    ("K", "Bangladeshi", "Asian or Asian British"),
    ("L", "Any other Asian background", "Asian or Asian British"),
    ("M", "Caribbean", "Black, Black British, Caribbean or African"),
    ("N", "African", "Black, Black British, Caribbean or African"),
    ("P", "Any other Black background", "Black, Black British, Caribbean or African"),
    ("R", "Chinese", "Asian or Asian British"),
    ("S", "Any other ethnic group", "Other ethnic group"),
    ("T", "Traveller", "White"),
    ("W", "Arab", "Other ethnic group"),
    ("Z", "Not stated", "Not known"),
    ("99", "Not known (2013 onwards)", "Not known"),
    ("X", "Not known (prior to 2013)", "Not known"),
]

# Ethnic category codes in use before 2003 (code, description, present code).
ETHNICITY_PRE_2003 = [
    ("0", "White", "A"),
    ("1", "Black - Caribbean", "M"),
    ("2", "Black - African", "N"),
    ("3", "Black - Other", "P"),
    ("4", "Indian", "H"),
    ("5", "Pakistani", "J"),
    ("6", "Bangladeshi", "K"),
    ("7", "Chinese", "R"),
    ("8", "Any other ethnic group", "S"),
    ("9", "Not given", "Z"),
]

# Sex codes by source; codes not listed are kept as they are.
SEX_GDPPR = {"0": None, "1": "M", "2": "F", "9": "I"}
SEX_HES_APC = {"0": None, "1": "M", "2": "F", "3": "I", "9": "I", "X": None}
SEX_HES_OP = {"0": None, "1": "M", "2": "F", "9": "I", "X": None}
SEX_HES_AE = SEX_HES_APC
SEX_SSNAP = {"M": "M", "F": "F"}

# Ethnic category codes that say nothing about a person, and the date that stands for no date.
ETHNICITY_NULL_CODES = ["", "X", "Z", "99"]
NO_DATE = "1899-12-30"

CATEGORY_DESCRIPTION = {code: description for code, description, _ in ETHNICITY_CATEGORIES}
CATEGORY_BROAD_GROUP = {code: group for code, _, group in ETHNICITY_CATEGORIES}
PRE_2003_DESCRIPTION = {code: description for code, description, _ in ETHNICITY_PRE_2003}
PRE_2003_CATEGORY = {code: category for code, _, category in ETHNICITY_PRE_2003}

_PACKAGED = {
    "antigen_tests": (ANTIGEN_TESTS, "code string, description string, test_result string"),
    "infection_snomed": (INFECTION_CODES, "code string, description string, covid_status string"),
    "ethnicity_categories": (ETHNICITY_CATEGORIES, "code string, description string, ethnic_broad_group string"),
    "ethnicity_pre_2003": (ETHNICITY_PRE_2003, "code string, description string, ethnic_category string"),
}


def packaged_codelist(spark: SparkSession, name: str) -> DataFrame:
    """One of the packaged lists as a table of text columns."""
    if name not in _PACKAGED:
        raise ValueError(f"Unknown codelist {name!r}; packaged are {', '.join(_PACKAGED)}.")
    rows, schema = _PACKAGED[name]
    return spark.createDataFrame(rows, schema)
