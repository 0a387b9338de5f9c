"""DataFrame -> DataFrame operators; none of them triggers a job unless stated."""
