"""Export of the payload as files, and of the requests that would submit it."""
