"""From a declared job to DataFrame steps."""
