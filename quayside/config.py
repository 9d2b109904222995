"""Declared schemas, file manifests and per-customer endpoint columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# Declared tables.
CLICKSTREAM_SCHEMA = "element_clicked string, time_spent int, source_menu string, created_at string"
RECORD_SCHEMA = "recordId string, data string, arrival_ts timestamp_ntz"
PERSONAL_HEALTH_SCHEMA = (
    "mpi string, firstName string, lastName string, email string, gender string, "
    "mobileNumber string, clinicId string, creditCardNumber string, "
    "driverLicenseNumber string, patientJobTitle string, ssn string, geo string, mbi string"
)
SALES_SCHEMAS = {
    "leaddata": (
        "leadsource string, jobrole string, contactnotes string, leadprofile string, "
        "usedpromo string, donotreachout boolean, region string, converted int, prospectid string"
    ),
    "webdata": (
        "webidentity int, prospectid string, lastcampaignactivity string, "
        "pageviewspervisit decimal(20,2), totaltimeonwebsite int, totalwebsitevisits int, "
        "attendedmarketingevents string, organicsearch string, viewedadvertisement string"
    ),
    "customer": "id int, name string, phonenumber string",
    "ordertable": "id int, customer_id int",
    "orderitem": "id int, order_id int, product_id int, quantity int",
}
SALES_KEYS = {
    "leaddata": "prospectid",
    "webdata": "webidentity",
    "customer": "id",
    "ordertable": "id",
    "orderitem": "id",
}
ENROLLMENT_TEXT_COLUMNS = ("DateCompleted", "CourseCollectionId", "DateExpires", "AccessDate")

# Files a delivery must hold.
MIGRATION_FILES = (
    "certifiedusers.csv;coursefeedbacks.csv;courses.csv;coursesintracks.csv;credits.csv;"
    "enrollments.csv;instructorrating.csv;learners.csv;performance.csv;tracks.csv"
)
NEW_CLIENT_FILES = (
    "CurrentCourses.csv;UserEnrollments.csv;CreditClaimed.csv;Learners.csv;CourseFeedback.csv;"
    "CertifiedUsers.csv;InstructorRatings.csv;CoursePerformance.csv;CourseInTracks.csv;Tracks.csv"
)

# Columns and report names of the status view, in report order.
STATUS_REPORT = {
    "customer": "Customer",
    "source": "Source",
    "lrd": "Last Refresh",
    "status": "Status",
    "info": "Info",
    "airflow": "Airflow",
}


def required_files(text: str) -> list[str]:
    """Names of a ``;``-separated manifest."""
    return [name.strip() for name in text.split(";") if name.strip()]


def endpoint_columns(config: Mapping, customer: str, endpoint: str) -> Sequence[str]:
    """Configured columns of one endpoint of one customer, in configured order."""
    return list(config["Customer"][customer]["Columns"][endpoint])
