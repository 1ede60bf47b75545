"""Daily files of the three clinics' shapes, with invented people."""

from datetime import date
from pathlib import Path

DAY = date(2010, 1, 2)
PATIENT_HEAD = "FName,LName,Email,Address,City,State,ZipCode"
VISIT_HEADS = {
    "Bellevue": "Time,Patient,Doctor,Procedure,Charge",
    "Kirkland": "Time,Patient,Clinic,Doctor,Procedure,Charge",
    "Redmond": "Time,Clinic,Patient,Doctor,Procedure,Charge",
}
PATIENTS = {
    "Bellevue": [
        "Ann,Ames,ann.example.com,1 A St,Bellevue,WA,98004",
        "Bo,Burr,bo@example.com,2 B St,Bellevue,WA,98004",
        "Cy,Cole,cy@example.com,3 C St,Bellevue,WA,98005",
    ],
    "Kirkland": ["Di,Dunn,di@example.com,4 D St,Kirkland,WA,98033"],
    "Redmond": [
        "Ed,Elm,ed@example.com,5 E St,Redmond,WA,98052",
        "Flo,Fox,flo@example,6 F St,Redmond,WA,98052",
    ],
}
COUNTS = {"Bellevue": 50, "Kirkland": 48, "Redmond": 56}


def visit_lines(clinic, n):
    for i in range(n):
        time, patient, doctor, procedure, charge = f"{9 + i % 9}:{i % 2 * 30:02d}", i, i % 14, i % 49, 100 + i
        yield {
            "Bellevue": f"{time},{patient},{doctor},{procedure},{charge}",
            "Kirkland": f"{time},{patient},2,{doctor},{procedure},{charge}",
            "Redmond": f"{time},3,{patient},{doctor},{procedure},{charge}",
        }[clinic]


def write(path: Path, head, lines):
    """UTF-8 with byte-order mark and CRLF line ends, as the clinics send it."""
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("﻿" + "".join(x + "\r\n" for x in [head, *lines])).encode())


def write_day(folder: Path, day=DAY, counts=COUNTS, patients=PATIENTS):
    for clinic, n in counts.items():
        write(folder / clinic / f"{day:%Y%m%d}NewPatients.csv", PATIENT_HEAD, patients[clinic])
        write(folder / clinic / f"{day:%Y%m%d}Visits.csv", VISIT_HEADS[clinic], visit_lines(clinic, n))
    return str(folder)
