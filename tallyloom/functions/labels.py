"""Label tables of the survey. They must match the published survey coding."""

# N: does not exist, EW: exists and functions well, EP: exists and functions poorly.
# Keys are matched after runs of whitespace are reduced to one blank.
AUTHORITY = {
    "A dedicated body authority does not exist": "N",
    "A dedicated authority body does not exist": "N",
    "Exist and provides regular inspections of facilities and reports at least annually": "EW",
    "A dedicated body authority undertakes regular inspections, responds to complaints, and reports its findings at least once a year": "EW",
    "A dedicated authority undertakes regular inspections,responds to complaints and reports its findings at least once a year": "EW",
    "A dedicated body exists but it is not functioning well": "EP",
    "exists but not fully functioning": "EP",
    "A dedicated authority undertakes irregular inspections of mental health services and irregularly responds to complaints of human rights violations": "EP",
    "A dedicated body does not exist": "N",
    "A dedicated body undertakes irregular inspections of mental health services and irregularly responds to complaints of human rights violations": "EP",
    "A dedicated authority body exists but it is not functioning well": "EP",
    "A dedicated authority undertakes regular inspections, responds to complaints, and reports its finding at least once a year": "EW",
    "A dedicated authority undertakes regular inspections, responds to complaints, and reports its findings at least once a year": "EW",
    "A dedicated authority undertakes regular inspections, responds to complaints and reports its findings at least once a year": "EW",
}

# FI: fully insured, 20: at least 20% paid by the person, M: mostly paid by the person.
PAYMENT = {
    "Persons pay nothing at the point of service use (fully insured)": "FI",
    "Persons pay mostly or entirely out of pocket for services": "M",
    "Persons pay mostly or entirely out of pocket medicines": "M",
    "Persons pay mostly or entirely out of pocket for medicines": "M",
    "Persons pay at least 20% towards the cost of services": "20",
    "Persons pay at least 20% towards the cost of medicines": "20",
    "Persons pay atleast 20% towards the cost of services": "20",
    "nothing, fully insured": "FI",
    "at least 20% paid by individual": "20",
    "Persons pay nothing at the point of service use(fully insured)": "FI",
    "Personds pay nothing at the point of service use(fully insured)": "FI",
    "persons pay nothing at the point of service use(fully insured)": "FI",
    "Personds pay nothing at the point of service use (fully insured)": "FI",
    "mostly paid by individuals": "M",
}

# Share bands as ordered categories.
SHARE_BAND = {
    "less-25": 1.0,
    "25-less": 1.0,
    "25": 1.0,
    "26-50": 2.0,
    "51-75": 3.0,
    "more-75": 4.0,
    "More-75": 4.0,
}

# Null markers of the programme table.
PROGRAMME_MARKERS = ("-", "-,-,-,-", "??")
