"""The same jobs over growing inputs."""
