"""The two end-to-end jobs: the monthly status report and the engagement details."""
