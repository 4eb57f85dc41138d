"""DataFrame-to-DataFrame steps, usable on static and streaming inputs."""
