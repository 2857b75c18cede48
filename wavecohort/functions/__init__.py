"""wavecohort."""
