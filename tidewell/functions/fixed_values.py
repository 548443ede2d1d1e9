"""Lists and tables that results depend on, stated as they are.

Nothing here is logic. Country names, lexicons and code crosswalks are not
here: they are DataFrame arguments of the operators that need them.
"""

# Trial status -> harmonised "approval, status" text.
TRIAL_STATUS = {
    "NOT_YET_RECRUITING": "Authorised, recruitment pending",
    "RECRUITING": "Ongoing, recruiting",
    "ACTIVE_NOT_RECRUITING": "Ongoing, recruitment ended",
    "ENROLLING_BY_INVITATION": "Ongoing, recruiting",
    "COMPLETED": "Ended, ended",
    "TERMINATED": "Ended, ended",
    "WITHDRAWN": "Ended, ended",
    "SUSPENDED": "Ended, ended",
}
LOCATION_STATUS_DEFAULT = "Ended, ended"

# Days per age unit.
UNIT_DAYS = {
    "minutes": 1 / 1440,
    "hours": 1 / 24,
    "days": 1.0,
    "weeks": 7.0,
    "months": 30.0,
    "years": 365.0,
}

# EU age bucket -> (min days, max days).
AGE_BUCKETS = {
    "preterm newborn infants (up to gestational age<37 weeks)": (None, 0),
    "in utero": (None, 0),
    "0-27 days": (0, 28),
    "28 days-23 months": (28, 720),
    "2-5 years": (730, 2190),
    "6-11 years": (2190, 4380),
    "12-17 years": (4380, 6570),
    "0-17 years": (0, 6570),
    "18-64 years": (6570, 23725),
    "65-84 years": (23725, 31025),
    "85+ years": (31025, None),
    "65+ years": (23725, None),
}

# EU register header -> output column.
CTIS_COLUMNS = {
    "Title of the trial": "title",
    "Trial number": "trial_id",
    "Trial results": "results",
    "Number of participants enrolled": "enrollment",
    "Overall trial status": "overall_status",
    "Protocol code": "sponsor_code",
    "Last updated": "last_updated",
    "Start date": "start_date",
    "End date": "end_date",
    "Decision date": "decision_date",
    "Global end of the trial": "global_end_date",
    "Sponsor/Co-Sponsors": "sponsor",
    "Sponsor type": "sponsor_type",
}

# Texts that mean "no value".
NA_TOKENS = ("", "NA", "N/A")

# Code shapes looked for in upper-cased text.
ICD11_PATTERN = r"\b([A-Z]{1,2}\d[A-Z0-9](?:\.[A-Z0-9]{1,2})?|\d[A-Z]\d{2}(?:\.[A-Z0-9]{1,2})?)\b"
ICD10_PATTERN = r"\b([A-Z]\d{2}(?:\.\d{1,2})?)\b"

# Chapters whose codes are never matched to text.
EXCLUDED_CHAPTERS = (
    "x", "complementary_factors", "supplementary_conditions",
    "supplementary_factors", "supplementary_populations", "v", "purposes",
)

# First character of a code -> chapter.
CHAPTER_OF_LETTER = {
    "1": "certain_infectious",
    "2": "neoplasms",
    "3": "blood",
    "4": "endocrine",
    "5": "mental",
    "6": "nervous",
    "7": "eye",
    "8": "ear",
    "9": "circulatory",
    "a": "respiratory",
    "b": "digestive",
    "c": "skin",
    "d": "musculoskeletal",
    "e": "genitourinary",
    "f": "pregnancy",
    "g": "perinatal",
    "h": "congenital",
    "j": "symptoms",
    "k": "injury",
    "l": "external",
    "m": "factors_health",
    "n": "purposes",
    "p": "supplementary_factors",
    "q": "complementary_factors",
    "r": "supplementary_conditions",
    "s": "supplementary_populations",
    "t": "supplementary_contexts",
    "u": "supplementary_settings",
}

# Indicator code -> cause id of the burden data.
INDICATOR_CAUSE = {
    "SA_0000001419": 429,
    "SA_0000001420": 441,
    "SA_0000001421": 976,
    "SA_0000001422": 698,
    "SA_0000001423": 697,
    "SA_0000001424": 699,
    "SA_0000001425": 493,
    "SA_0000001426": 421,
    "SA_0000001427": 525,
    "SA_0000001429": 444,
    "SA_0000001430": 411,
    "SA_0000001431": 703,
    "SA_0000001432": 381,
    "SA_0000001433": 693,
    "SA_0000001434": 721,
    "SA_0000001435": 716,
    "SA_0000001436": 945,
    "SA_0000001689": 495,
    "SA_0000001418": 560,
}

# Sex code -> sex id of the burden data.
SEX_ID = {"SEX_BTSX": 3, "SEX_FMLE": 2, "SEX_MLE": 1}

# Ids given to every indicator record.
INDICATOR_CONSTANTS = {"measure": 2, "age": 27, "metric": 3, "population_group": 1}

# Columns of the burden row key, in key order.
BURDEN_KEY = (
    "age", "cause", "etiology", "location", "measure",
    "metric", "population_group", "sex", "year",
)

# Fact source name -> source key.
SOURCE_KEY = {"IHME": 9, "GHO": 7}

# Author text that stands for "unknown".
AUTHOR_PLACEHOLDER = "#author.fullName}"

# Topic label -> phrases, headline service, in precedence order.
NEWS_TOPICS = {
    "core_health": [
        "public health", "global health", "health crisis", "disease outbreak",
        "pandemic", "epidemic", "vaccination", "vaccine", "who ",
        "infectious disease", "preventive care", "immunization",
    ],
    "mental_health": [
        "mental health", "mental illness", "psychiatry", "depression",
        "anxiety disorder", "bipolar disorder", "schizophrenia",
        "suicide prevention", "eating disorder", "ptsd",
        "psychological wellbeing", "psychotherapy",
    ],
    "disability": [
        "disability", "disabled", "accessibility", "assistive technology",
        "neurodiversity", "autism spectrum", "adhd", "learning disability",
        "chronic pain", "invisible illness",
    ],
    "cancer_research": [
        "cancer research", "oncology", "tumour", "tumor", "chemotherapy",
        "immunotherapy", "cancer clinical trial", "breast cancer",
        "lung cancer", "cancer screening", "leukaemia", "melanoma",
    ],
    "rare_chronic": [
        "rare disease", "orphan drug", "chronic illness",
        "multiple sclerosis", "parkinson", "alzheimer",
        "cystic fibrosis", "sickle cell", "lupus",
        "rheumatoid arthritis", "fibromyalgia",
    ],
    "neurology": [
        "neurology", "neuroscience", "brain health", "stroke",
        "dementia", "epilepsy", "traumatic brain injury",
        "spinal cord", "neurodegeneration", "cognitive decline",
    ],
    "healthcare_policy": [
        "healthcare policy", "nhs", "universal health coverage",
        "health insurance", "medical reform", "patient rights",
        "health equity", "social determinants of health",
        "drug pricing", "pharmaceutical regulation",
    ],
    "medical_research": [
        "medical research", "clinical trial", "drug discovery",
        "genomics", "gene therapy", "biomarker",
        "precision medicine", "mrna", "crispr",
        "ai in healthcare", "digital health",
    ],
}

# Topic label -> phrases, search service, in precedence order.
CURRENTS_TOPICS = {
    "mental_health": [
        "mental health", "mental illness", "psychiatric",
        "depression", "anxiety disorder", "bipolar",
        "schizophrenia", "suicide prevention", "eating disorder",
        "ptsd", "psychological wellbeing",
    ],
    "disability": [
        "disability", "disabled", "accessibility",
        "assistive technology", "neurodiversity",
        "autism spectrum", "adhd", "learning disability",
        "chronic pain", "invisible illness", "wheelchair",
    ],
    "cancer_research": [
        "cancer", "oncology", "tumour", "tumor",
        "chemotherapy", "immunotherapy", "leukaemia",
        "melanoma", "cancer screening", "oncologist",
    ],
    "rare_chronic": [
        "rare disease", "orphan drug", "chronic illness",
        "multiple sclerosis", "parkinson", "alzheimer",
        "cystic fibrosis", "sickle cell", "lupus",
        "rheumatoid arthritis", "fibromyalgia", "dementia",
    ],
    "neurology": [
        "neurology", "neuroscience", "brain health", "stroke",
        "epilepsy", "traumatic brain injury", "spinal cord",
        "neurodegeneration", "cognitive decline", "brain tumour",
    ],
    "healthcare_policy": [
        "healthcare policy", "nhs", "universal health coverage",
        "health insurance", "medical reform", "patient rights",
        "health equity", "social determinants", "drug pricing",
        "pharmaceutical regulation", "health funding",
    ],
    "medical_research": [
        "clinical trial", "drug discovery", "genomics",
        "gene therapy", "biomarker", "precision medicine",
        "mrna", "crispr", "ai in healthcare", "digital health",
        "medical research", "randomised controlled",
    ],
    "core_health": [
        "public health", "global health", "health crisis",
        "disease outbreak", "pandemic", "epidemic",
        "vaccination", "immunisation", "infectious disease",
        "who ", "preventive care",
    ],
}

# Spending category id -> name.
SPENDING_CATEGORIES = {
    6: "Acquired Cognitive Impairment (incl. Alzheimer's)", 7: "Aging",
    14: "Brain Disorders", 16: "Behavioral and Social Science",
    26: "Cancer", 28: "Cardiovascular", 29: "Chronic Pain",
    31: "Clinical Research", 54: "Depression", 57: "Diabetes",
    72: "Health Disparities", 76: "HIV/AIDS", 85: "Infectious Diseases",
    87: "Injury (Trauma -- Accidents and Adverse Effects)", 89: "Kidney Disease",
    90: "Lung Disease", 92: "Mental Health", 96: "Neurological",
    98: "Nutrition", 100: "Obesity", 101: "Orphan Drug", 105: "Pediatric",
    108: "Physical Activity", 116: "Rare Diseases", 120: "Rehabilitation",
    124: "Sexually Transmitted Infections", 126: "Spinal Cord Injury",
    128: "Stroke", 138: "Tobacco", 141: "Traumatic Brain Injury (TBI)",
    146: "Vision Research", 167: "Global Health", 172: "Health Economics",
    199: "Substance Abuse",
}
